"""Decontamination against brute force, with items of very different lengths, and with changed words."""

import math
import random
import re
from collections import Counter

from aftermath.llm import decontaminate
from aftermath.llm.decontaminate import Settings, question_and_answer, stride_of

SCHEMA = "doc_id long, text string"


def words(text):
    return re.findall(r"[a-z0-9]+", text.lower())


def sets(seq, n=3):
    return {tuple(seq[i : i + n]) for i in range(len(seq) - min(n, len(seq)) + 1)} if seq else set()


def share(side, passage):
    if not side:
        return 1.0
    mine = sets(side)
    there = sets(passage, min(3, len(side)))
    if len(side) < 3 or len(mine) == 1:
        return float(bool(mine & there))
    return len(mine & there) / len(mine)


def brute(docs, items, s=Settings()):
    """Every pair of a document and an item, every passage, dictionaries only."""
    bags = {i: Counter(words(t)) for i, t in items}
    df = Counter(w for bag in bags.values() for w in bag)
    mean = sum(sum(b.values()) for b in bags.values()) / len(bags)
    found = set()
    for i, text in items:
        length = sum(bags[i].values())
        impact = {}
        for w, tf in bags[i].items():
            idf = math.log(1 + (len(items) - df[w] + 0.5) / (df[w] + 0.5))
            impact[w] = idf * tf * (s.k1 + 1) / (tf + s.k1 * (1 - s.b + s.b * length / mean))
        total, stride = sum(impact.values()), stride_of(length, s)
        sides = [words(x) for x in question_and_answer(text)]
        for d, doc in docs:
            seq = words(doc)
            for at in range(0, max(len(seq), 1), stride):
                passage = seq[at : at + 2 * stride]
                score = sum(v for w, v in impact.items() if w in set(passage)) / total
                whole = share(words(text), passage) >= s.whole
                if score >= s.threshold and all(share(x, passage) >= s.overlap or (whole and len(x) < s.short) for x in sides):
                    found.add((d, i))
    return found


def pairs(rows):
    return {(r.doc_id, r.item_id) for r in rows}


def frames(spark, docs, items):
    return spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_found_items_are_those_of_brute_force(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.choice([3, 6, 12])) + "? " + prose(rng, rng.choice([2, 9, 40, 150]))) for i in range(24)]
    docs = []
    for d in range(60):
        seq = words(items[d % 24][1])
        for _ in range(rng.choice([0, 0, 1, 2, len(seq) // 4])):
            seq[rng.randrange(len(seq))] = "changed"
        if d % 5 == 4:  # the two halves apart, at distances on both sides of a passage
            seq[len(seq) // 2 : len(seq) // 2] = words(prose(rng, rng.choice([20, 90, 500])))
        docs.append((d, f"{prose(rng, rng.randrange(300))} {' '.join(seq)} {prose(rng, rng.randrange(300))}"))
    want = brute(docs, items)
    assert 30 <= len(want) < 24 * 60
    assert pairs(decontaminate.leaks(*frames(spark, docs, items)).collect()) == want


def test_a_long_item_changes_nothing_for_others(spark):
    rng = random.Random(6)
    question, answer = prose(rng, 12, 10**6), prose(rng, 20, 10**6)
    docs = [(1, f"{question}? {prose(rng, 600, 10**6)} {answer}"), (2, f"{question}? {answer}")]
    items = [(1, f"{question}? {answer}")]
    long = (2, "Which one? " + prose(rng, 2000, 10**6))
    assert pairs(decontaminate.leaks(*frames(spark, docs, items)).collect()) == {(2, 1)}
    held = (3, f"some words before {long[1]} and some after")
    assert pairs(decontaminate.leaks(*frames(spark, docs + [held], items + [long])).collect()) == {(2, 1), (3, 2)}


def test_a_changed_word_in_a_short_side_hides_nothing(spark):
    rng = random.Random(7)
    answer = prose(rng, 40, 10**6)
    items = [(1, f"what is that thing? {answer}")]
    docs = [(1, f"what was that thing? {answer}"), (2, answer[: len(answer) // 2]), (3, "what is that thing? " + prose(rng, 40, 10**6)), (4, None), (5, "")]
    assert pairs(decontaminate.leaks(*frames(spark, docs, items)).collect()) == {(1, 1)}
