"""Benchmark decontamination: a BM25 index of test items, block-max pruning, question and answer overlap."""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace
from aftermath.llm.words import PUNCTUATION, WHITESPACE, chunks, column_bytes, mixed, word_table, words_of

TABLE = word_table(WHITESPACE + PUNCTUATION, lower=True)
# Test items of about this many bytes make one index, which is broadcast; more items are searched in turns.
INDEX_BYTES = 16 << 20
ITEMS_PER_BLOCK = 16


@dataclass(frozen=True)
class Settings:
    """``threshold`` and ``common`` are parts of the score that an item gives itself.

    ``stride`` is the shortest stride of passages, in words; an item of more
    words is looked for with the least doubling of it that holds the item. A side of fewer than ``short``
    words counts as found too if the passage has ``whole`` of the item's shingles.
    """

    threshold: float = 0.5
    common: float = 0.3
    overlap: float = 0.6
    short: int = 10
    whole: float = 0.8
    shingle: int = 3
    stride: int = 64
    k1: float = 1.2
    b: float = 0.75


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's first line and the rest; else its first sentence and the rest; else two halves."""
    for part in (r"\s*\n\s*", r"(?<=[.?!])\s+"):
        pieces = re.split(part, text.strip(), maxsplit=1)
        if len(pieces) == 2 and pieces[1].strip():
            return pieces[0], pieces[1]
    words = text.split()
    half = (len(words) + 1) // 2
    return " ".join(words[:half]), " ".join(words[half:])


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Distinct hashes of n words in a row; of all words if there are fewer."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out) + words[k : len(words) - n + 1 + k] * np.uint64(2 * k + 1)
    return np.unique(out)


def lowered(column: pa.Array) -> list[bytes]:
    """The one lower case of items, their sides and documents: ``str.lower`` differs for a final sigma and U+0130."""
    return column_bytes(pc.utf8_lower(column.cast(pa.string())))


def stride_of(words: int, s: Settings) -> int:
    """The stride of the passages that an item of so many words is looked for in; other items do not matter."""
    stride = s.stride
    while stride < words:
        stride *= 2
    return stride


class Index:
    """Postings of some items of one stride, their block maxima and their questions and answers.

    Weights are BM25 impacts divided by the score of the item for its own text,
    so one threshold serves all items. The commonest terms of an item, up to
    ``common`` of its score, are not needed to find it: a passage above the
    threshold has the missing part in its other, essential terms.
    """

    def __init__(self, ids: list, texts: list[str], df: dict[int, int], items: int, mean: float, stride: int, s: Settings):
        words, first = words_of(lowered(pa.array(texts, pa.string())), TABLE)
        self.ids, self.stride, rows = ids, stride, []
        for i in range(len(ids)):
            terms, tf = np.unique(words[first[i] : first[i + 1]], return_counts=True)
            n = np.array([df[int(t)] for t in terms.view(np.int64)], float)
            idf = np.log1p((items - n + 0.5) / (n + 0.5))
            length = max(first[i + 1] - first[i], 1)
            impact = idf * tf * (s.k1 + 1) / (tf + s.k1 * (1 - s.b + s.b * length / mean))
            weight = impact / max(impact.sum(), 1e-300)
            order = np.argsort(weight / np.maximum(tf, 1), kind="stable")
            spare = np.zeros(len(terms), bool)
            spare[order] = np.cumsum(weight[order]) <= s.common
            rows.append((terms, weight, spare))
        count = [len(r[0]) for r in rows]
        terms = np.concatenate([r[0] for r in rows])
        item = np.repeat(np.arange(len(ids)), count)
        weight = np.concatenate([r[1] for r in rows])
        spare = np.concatenate([r[2] for r in rows])
        self.terms, number = np.unique(terms, return_inverse=True)
        order = np.lexsort((item, number))
        self.item, self.weight = item[order], weight[order]
        self.at = np.searchsorted(number[order], np.arange(len(self.terms) + 1))
        self.seen = np.zeros(1 << 18, bool)
        self.seen[(self.terms & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
        missing = s.threshold - np.bincount(item[spare], weight[spare], minlength=len(ids))
        self.blocks = -(-len(ids) // ITEMS_PER_BLOCK)
        self.need = np.minimum.reduceat(missing, np.arange(0, len(ids), ITEMS_PER_BLOCK))
        # the largest essential weight of a term in each block of items
        key = number[~spare] * self.blocks + item[~spare] // ITEMS_PER_BLOCK
        keys, where = np.unique(key, return_inverse=True)
        self.most = np.zeros(len(keys))
        np.maximum.at(self.most, where, weight[~spare])
        self.most_block = keys % self.blocks
        self.most_at = np.searchsorted(keys // self.blocks, np.arange(len(self.terms) + 1))
        self.sides, self.short, self.whole = [], [], []
        for i, text in enumerate(texts):
            sides = words_of(lowered(pa.array(question_and_answer(text), pa.string())), TABLE)
            self.sides.append([shingles(sides[0][sides[1][k] : sides[1][k + 1]], s.shingle) for k in (0, 1)])
            self.short.append([sides[1][k + 1] - sides[1][k] < s.short for k in (0, 1)])
            self.whole.append(shingles(words[first[i] : first[i + 1]], s.shingle))

    def spread(self, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row all places at[row] to at[row + 1]: number of the row, place."""
        n = at[rows + 1] - at[rows]
        owner = np.repeat(np.arange(len(rows)), n)
        return owner, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[rows], n)

    def search(self, words: np.ndarray, first: np.ndarray, s: Settings) -> list[tuple]:
        """(text, item, passage, score, question overlap, answer overlap) of every item found in texts, given by their words."""
        spots = np.flatnonzero(self.seen[(words & np.uint64((1 << 18) - 1)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.terms, words[spots]), len(self.terms) - 1)
        known = self.terms[number] == words[spots]
        spots, number = spots[known], number[known]
        if not len(spots):
            return []
        # A passage is two strides of a text; a word is in the passage of its stride and in the one before.
        lengths = np.diff(first)
        strides = np.maximum(-(-lengths // self.stride), 1)
        base = np.concatenate(([0], np.cumsum(strides)))
        text = np.searchsorted(first, spots, "right") - 1
        segment = base[text] + (spots - first[text]) // self.stride
        owner, place = self.spread(self.most_at, number)
        mine = segment[owner]
        earlier = mine > base[text[owner]]
        passage = np.concatenate((mine, mine[earlier] - 1))
        place = np.concatenate((place, place[earlier]))
        pair = passage * self.blocks + self.most_block[place]
        pairs, where = np.unique(pair, return_inverse=True)
        bound = np.bincount(where, self.most[place])
        pairs = pairs[bound >= self.need[pairs % self.blocks] - 1e-9]
        best: dict[tuple[int, int], tuple] = {}
        passages, cuts = np.unique(pairs // self.blocks, return_index=True)
        for p, blocks in zip(passages.tolist(), np.split(pairs % self.blocks, cuts[1:])):
            t = int(np.searchsorted(base, p, "right")) - 1
            begin = int(first[t] + (p - base[t]) * self.stride)
            end = int(min(begin + 2 * self.stride, first[t + 1]))
            a, b = np.searchsorted(spots, (begin, end))
            _, at = self.spread(self.at, np.unique(number[a:b]))
            score = np.bincount(self.item[at], self.weight[at], minlength=len(self.ids))
            above = np.flatnonzero(score >= s.threshold - 1e-9)
            above = above[np.isin(above // ITEMS_PER_BLOCK, blocks)]
            here = shingles(words[begin:end], s.shingle) if len(above) else None
            for i in above.tolist():
                q, a2 = (contained(side, here, words[begin:end], s.shingle) for side in self.sides[i])
                most = any(self.short[i]) and contained(self.whole[i], here, words[begin:end], s.shingle) >= s.whole
                if all(x >= s.overlap or (most and short) for x, short in zip((q, a2), self.short[i])):
                    row = (t, i, p - int(base[t]), float(score[i]), q, a2)
                    if (t, i) not in best or row[3] > best[t, i][3]:
                        best[t, i] = row
        return list(best.values())


def contained(side: np.ndarray, here: np.ndarray, words: np.ndarray, n: int) -> float:
    """The part of an item's shingles that a passage has; nothing to find counts as found.

    A side of fewer than ``n`` words is one shorter shingle, looked for at its own length.
    """
    if not len(side):
        return 1.0
    if len(side) == 1:
        return float(any(np.isin(side, shingles(words, k)).all() for k in range(1, n + 1)))
    return float(np.isin(side, here).mean())


def leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, item_id, passage, score, question_overlap, answer_overlap): every item that a document holds.

    Every passage of every whole text is a query; the row names the best one,
    of equal scores the first. A passage is as long as two strides of an item's length class, so
    whether an item is found depends on its text and the documents, and on
    other items only through the frequencies of words.
    Items without words are never found; items with equal texts are each found.
    Null and empty texts hold nothing. Repeated rows give repeated results, and
    a null id stays null. Without items the result is empty. Other columns are
    ignored.
    """
    spark = docs.sparkSession
    space = Workspace(spark, "leaks")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    turns = max(1, -(-int(size) // INDEX_BYTES))
    items = items.withColumn("turn", F.pmod(F.xxhash64("item_id", "text"), F.lit(turns)))

    def terms(batches):
        for batch in batches:
            words, first = words_of(lowered(batch.column(1)), TABLE)
            for i in range(len(first) - 1):
                own = words[first[i] : first[i + 1]]
                found = np.unique(own)
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, batch.column(0)[i].as_py(), np.int64)), pa.array(found.view(np.int64)), pa.array(np.where(np.arange(n) == 0, len(own), 0))],
                    ["turn", "term", "words"],
                )

    postings = space.write(items.select("turn", "text").mapInArrow(terms, "turn long, term long, words long"), "postings")
    counted = items.where(F.col("text").rlike(r"[^\s\p{Punct}]")).count()
    mean = (postings.agg(F.sum("words")).first()[0] or 1) / max(counted, 1)
    holding = space.write(postings.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "holding")
    schema = "doc_id long, item_id long, passage long, score double, question_overlap double, answer_overlap double"
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = spark.createDataFrame([], schema)
    for turn in range(turns):
        # both are bounded by INDEX_BYTES
        own = items.where(F.col("turn") == turn).orderBy("item_id", "text").select("item_id", "text").toArrow()
        own = [(i, t) for i, t in zip(own["item_id"].to_pylist(), own["text"].to_pylist()) if t and len(words_of(lowered(pa.array([t])), TABLE)[0])]
        if not own:
            continue
        used = postings.where(F.col("turn") == turn).select("term").distinct().join(holding, "term").toArrow()
        df = dict(zip(used["term"].to_pylist(), used["n"].to_pylist()))
        classes: dict[int, list] = {}
        for i, t in own:
            length = len(words_of(lowered(pa.array([t])), TABLE)[0])
            classes.setdefault(stride_of(length, settings), []).append((i, t))
        made = [Index([i for i, _ in c], [t for _, t in c], df, counted, mean, stride, settings) for stride, c in sorted(classes.items())]
        found = found.unionByName(texts.mapInArrow(_searcher(spark.sparkContext.broadcast(made), settings), schema))
    return found


def _searcher(indexes, settings: Settings):
    def run(batches):
        for batch in batches:
            texts, ids = lowered(batch.column(1)), batch.column(0).to_pylist()
            rows = []
            for a, b in chunks(texts):
                words, first = words_of(texts[a:b], TABLE)
                for index in indexes.value:
                    rows += [(ids[a + t], index.ids[i], *rest) for t, i, *rest in index.search(words, first, settings)]
            names = ("doc_id", "item_id", "passage", "score", "question_overlap", "answer_overlap")
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run
