"""The pipeline over the smallest tables, stage by stage."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from aftermath.llm import decontaminate, jaccard, simhash
from aftermath.llm.shared import Workspace, components, table

FOLDER = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    space, docs = Workspace(spark, "pipeline-test"), table(spark, FOLDER, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = space.write(stage(spark, docs, FOLDER), name)
        kept[name] = docs
        if name != "sharding":
            assert docs.columns == columns
    once = kept["near_duplicates"]
    assert once.count() == once.select("doc_id").distinct().count()
    assert simhash.near_duplicates(once).where("doc_id <> component_id").isEmpty()
    assert decontaminate.leaks(kept["decontamination"], table(spark, FOLDER, "benchmark")).isEmpty()
    before, after = ({r[0] for r in kept[n].select("doc_id").collect()} for n in ("decontamination", "mixing"))
    assert before == after and kept["sharding"].count() == kept["mixing"].count()


def _jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def _brute_force(rows: list) -> dict:
    """The smallest id of the component of each (doc_id, text), by all pairs."""

    def shingled(text):
        words = (text or "").lower().split()
        n = min(5, len(words))
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()

    sets = {i: shingled(t) for i, t in rows}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and _jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in sets}


def test_near_duplicates_at_four_fifths_of_five_words(spark):
    rnd = random.Random(11)
    words = [f"v{i}" for i in range(3000)]
    rows = [(1, None), (2, " \n"), (3, "only three words"), (4, "ONLY three\twords"), (5, "only three wordz")]
    for base in range(12):
        text = rnd.choices(words, k=rnd.choice([30, 60, 200, 700]))
        for changed in (0, 0, 1, 2, 3, 4, 5, 6, 8, 12):
            copy = list(text)
            for at in rnd.sample(range(len(copy)), changed):
                copy[at] = f"new{rnd.random()}"
            rows.append((len(rows) + 1, " ".join(copy)))
    # a chain: neighbours are alike, its ends are not
    long = rnd.choices(words, k=400)
    rows += [(1000 + i, " ".join(long[25 * i : 25 * i + 250])) for i in range(7)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    got, want = {r.doc_id: r.component_id for r in found.collect()}, _brute_force(rows)
    assert got == want
    assert len({want[1000 + i] for i in range(7)}) == 1 and len(set(want.values())) > 12


def test_stage_groups_all_near_copies_of_the_test_table(spark):
    docs = table(spark, FOLDER, "documents")
    want = _brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    kept = corpus_pipeline.unique(spark, docs, FOLDER)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(set(want.values()))


def test_near_duplicates_in_a_band_of_many_texts(spark):
    """Texts with much in common share bands but are not alike; pairs hidden among them are found."""
    rnd = random.Random(3)
    words = [f"v{i}" for i in range(5000)]
    base, rows = rnd.choices(words, k=120), []
    for i in range(400):
        own = base + rnd.choices(words, k=80 if i % 2 else 30)
        rows.append((len(rows), " ".join(own)))
        if i % 8 == 0:
            for at in rnd.sample(range(120, len(own)), 2):
                own[at] = f"x{rnd.random()}"
            rows.append((len(rows), " ".join(own)))
    rows += [(len(rows) + i, " ".join([f"n{i}" if k == i else w for k, w in enumerate(base)])) for i in range(120)]
    found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == _brute_force(rows)


def _nearly_alike(texts: int, pairs: int) -> list:
    """Texts of similarity 0.78 to each other; each of the first ones has a partner at 0.802, which min-hashes hardly tell from the others."""
    rnd = random.Random(8)
    base, rows = [f"v{rnd.random()}" for _ in range(196)], []
    for i in range(texts):
        own = [f"w{i} {k}".replace(" ", "x") for k in range(27)]
        if pairs <= i < 2 * pairs:
            own[:3] = [f"w{i - pairs}x{k}" for k in range(3)]
        rows.append((i, " ".join(base + own)))
    return rows


def test_alike_texts_among_many_nearly_alike_ones_are_grouped(spark, monkeypatch):
    rows = _nearly_alike(300, 40)
    rows += [(1000 + i, " ".join([f"n{i}" if k == i else w for k, w in enumerate(rows[299][1].split())])) for i in range(60)]
    want = _brute_force(rows)
    assert sum(i != root for i, root in want.items()) == 40 + 60
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.unique(spark, docs.withColumn("source", F.lit("a")), FOLDER)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    # the same in blocks of a few, of which one component fills several
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs).collect()} == want


def test_forest_joins_each_likely_group_once():
    rnd = np.random.default_rng(4)
    base = rnd.integers(0, 256, (3, 128), dtype=np.uint8)
    sketches = np.repeat(base, 30, axis=0)
    flip = rnd.random(sketches.shape) < 0.1
    sketches = np.where(flip, rnd.integers(0, 256, sketches.shape), sketches).astype(np.uint8)
    pairs = jaccard.forest(sketches, np.arange(90), jaccard.agreeing(0.8), 0)
    assert len(pairs) == 87 and all(a // 30 == b // 30 for a, b in pairs)
    joined = np.arange(90) // 30
    assert jaccard.forest(sketches, joined, jaccard.agreeing(0.8), 4) == []
    half = np.where(np.arange(90) % 30 < 15, joined, joined + 10)
    assert len(jaccard.forest(sketches, half, jaccard.agreeing(0.8), 0)) == 3


def test_stages_keep_columns_that_clash_and_empty_tables(spark):
    schema = "doc_id long, text string, source string, _hash string, _row long, _refused string, block int, pass int, key long, node long"
    rnd = random.Random(9)
    texts = [" ".join(rnd.choices([f"u{k}" for k in range(900)], k=60)) for _ in range(30)] + [None, "", " "]
    rows = [(i, t, "ab"[i % 2], f"h{i}", i, "r", 1, 2, 3, 4) for i, t in enumerate(texts)] + [(None, texts[0], None, "n", 1, "r", 1, 2, 3, 4)]
    for frame, kept in ((spark.createDataFrame(rows, schema), 31), (spark.createDataFrame([], schema), 0)):
        for name, stage in corpus_pipeline.STAGES[1:4]:
            out = stage(spark, frame, FOLDER)
            assert out.columns == frame.columns
            got = {(r.doc_id, r._hash, r._row) for r in out.collect()}
            assert got <= {(r[0], r[3], r[4]) for r in rows}
            if name == "near_duplicates":
                assert len(got) == (kept and kept + 1)
            elif kept:
                assert len(got) == len(rows)
        assert corpus_pipeline.shards(spark, frame, FOLDER).count() == frame.count()


def test_mixture_holds_blocks_in_order_and_copies_lie_apart(spark):
    rows = [(i, f"word{i} " * 20, "large" if i < 900 else "small") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = corpus_pipeline.mixture(spark, docs, FOLDER)
    order = [r.doc_id for r in mixed.collect()]
    twice = {i for i in order if order.count(i) > 1}
    assert set(order) == set(range(1000)) and 0 < len(twice) <= 100 and min(twice) >= 900
    assert order != sorted(order)
    slots = corpus_pipeline.shards(spark, mixed, FOLDER).collect()
    by_shard = {}
    for r in slots:
        by_shard.setdefault(r.shard, {})[r.slot] = r.doc_id
    assert all(sorted(places) == list(range(len(places))) for places in by_shard.values())
    beside = sum(places[s] == places.get(s + 1) for places in by_shard.values() for s in places)
    assert beside < len(twice) / 4


def test_unique_tells_texts_of_one_id_apart(spark):
    first, other = (" ".join(random.Random(i).choices([f"u{k}" for k in range(900)], k=80)) for i in (1, 2))
    rows = [(1, first), (2, other), (2, other), (2, first), (3, other), (None, first)]
    kept = corpus_pipeline.unique(spark, spark.createDataFrame(rows, "doc_id long, text string"), FOLDER).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(1, first), (2, other), (None, first)], key=str)


def test_links_that_are_stars_take_no_round(spark):
    class Seen(Workspace):
        def write(self, df, name, batch_bytes=None):
            names.append(name)
            return super().write(df, name, batch_bytes)

    names = []
    stars = spark.createDataFrame([(1, 7), (9, 1), (1, 8), (3, 4)], "a long, b long")
    assert {tuple(r) for r in components(Seen(spark, "stars"), stars).collect()} == {(1, 1), (7, 1), (8, 1), (9, 1), (3, 3), (4, 3)}
    assert names == ["links-0"]
    more = spark.createDataFrame([(8, 4), (5, 6), (6, 5), (2, 2)], "a long, b long").unionByName(stars)
    assert {tuple(r) for r in components(Seen(spark, "stars"), more).collect()} == {(n, 1) for n in (1, 3, 4, 7, 8, 9)} | {(5, 5), (6, 5)}
    chain = spark.createDataFrame([(n, n + 1) for n in range(40)], "a long, b long")
    assert {tuple(r) for r in components(Seen(spark, "stars"), chain).collect()} == {(n, 0) for n in range(41)}


def test_keys_of_several_bands_are_not_written_out_for_each(spark):
    keys = spark.range(2).selectExpr(f"transform(sequence(1, {jaccard.BANDS}), i -> xxhash64(id, i)) AS keys")
    cut = jaccard.ROUNDS[-1]
    joined = keys.select("keys", jaccard._joined_bands(F.col("keys"), cut).alias("joined"))
    assert joined._jdf.queryExecution().analyzed().toString().count("xxhash64") <= len(cut) + 1
    alone = [F.xxhash64(*(F.col("keys")[(i + d) % jaccard.BANDS] for d in choice), F.lit(len(choice))) for choice in cut for i in range(jaccard.BANDS)]
    assert all(r.joined == r.alone for r in joined.withColumn("alone", F.array(*alone)).collect())
