"""Digests, file statistics, searches that open few files, and the change feed."""

import pytest
from pyspark.sql import functions as F

from aftermath.operators.costs import cost_by_disaster
from aftermath.operators.features import prior_events
from aftermath.plans.refresh import refreshed
from aftermath.sources import statistics
from aftermath.sources.store import KeyedStore


def opened(spark, tmp_path, buckets=4):
    return KeyedStore(spark, str(tmp_path / "store"), "k", "t", buckets=buckets)


def rows(spark, first, last, t, step=1):
    return spark.range(first, last, step).select(F.col("id").alias("k"), F.lit(t).alias("t"), (F.col("id") % 7).alias("v"))


def contents(df):
    return sorted(map(tuple, df.collect()), key=repr)


def digest_of(df):
    return df.agg(statistics.digest(df.schema).alias("d")).head().d


def test_digests_depend_on_values_and_counts_alone(spark):
    shape = "k long, a string, b string"
    one = spark.createDataFrame([(1, "x", None), (2, None, "y")], shape)
    assert digest_of(one) == digest_of(spark.createDataFrame([(2, None, "y"), (1, "x", None)], shape))
    assert digest_of(one) == digest_of(one.select("b", "k", F.lit(None).cast("int").alias("c"), "a"))
    for other in ([(1, None, "x"), (2, None, "y")], [(1, "x", None)], [(1, "x", None), (2, None, "y"), (2, None, "y")], [(2, "x", None), (1, None, "y")], []):
        assert digest_of(one) != digest_of(spark.createDataFrame(other, shape))
    assert digest_of(one.withColumn("m", F.create_map(F.lit("a"), "k"))) is None


def test_a_batch_is_known_again_without_a_look_at_the_store(spark, tmp_path, monkeypatch):
    store = opened(spark, tmp_path, 2)
    batch = rows(spark, 0, 50, "b").unionByName(rows(spark, 40, 60, "a"))
    store.upsert(rows(spark, 55, 58, "c"))
    first = store.upsert(batch)
    assert (first["new"], first["stale"], first["duplicates"]) == (57, 3, 10)
    looked, honest = [], KeyedStore._at
    monkeypatch.setattr(KeyedStore, "_at", lambda self, state, only=None, opened=None: looked.append(only) or honest(self, state, only, opened))
    again = store.upsert(batch.repartition(3))
    assert looked == [] and (again["unchanged"], again["stale"], again["duplicates"]) == (57, 3, 10)
    assert again["buckets_rewritten"] == 0 and again["incoming"] == 70
    changed = store.upsert(batch.withColumn("v", F.when((F.col("k") == 5), 99).otherwise(F.col("v"))))
    assert [len(only) for only in looked] == [1] and (changed["updated"], changed["unchanged"]) == (1, 56)
    monkeypatch.undo()
    whole = contents(store.read())
    store.compact()
    # after a compaction the whole content of a bucket is known again
    assert store.upsert(store.read())["buckets_rewritten"] == 0 and contents(store.read()) == whole


def test_searches_open_the_files_that_can_match(spark, tmp_path):
    store = opened(spark, tmp_path, 1)
    for i, t in enumerate("abcd"):
        store.upsert(rows(spark, 100 * i, 100 * i + 100, t))
    store.upsert(rows(spark, 0, 1, "d"))
    after = store.rows_after("c", 250)
    # the files of c and of d, and the late change of one row of a; not those of a and b
    assert len(after.inputFiles()) == 3
    want = store.read().where("t > 'c' OR (t = 'c' AND k > 250)")
    assert contents(after) == contents(want) and len(want.inputFiles()) == 5
    batch = spark.createDataFrame([(150,), (151,), (999,), (None,)], "k long")
    assert contents(store.known(batch)) == [(150,), (151,)]
    assert contents(store.fresh(batch)) == [(999,), (None,)]
    state = store.log.snapshot()
    assert len(store._holding(state, batch)) == 1
    assert store._holding(state, spark.createDataFrame([(10**6,)], "k long")) == set()
    assert len(store._holding(state, rows(spark, 0, 400, "x"))) == 5
    assert store.compact() == 1 and store.discard_replaced() == 5
    assert len(store.log._names(f"{store.root}/stats")) == 1


def test_an_empty_store_has_no_known_rows(spark, tmp_path):
    store = opened(spark, tmp_path)
    batch = rows(spark, 0, 3, "a")
    assert store.known(batch).count() == 0 and store.fresh(batch).count() == 3
    assert store.rows_after("a", 0) is None and store.changes(0) is None


@pytest.mark.parametrize("compacted", [False, True])
def test_derived_tables_follow_the_changes(spark, tmp_path, compacted):
    store = KeyedStore(spark, str(tmp_path / "store"), "k", "t", buckets=3)
    shape = "k long, t string, disaster long, state string, amount double"
    batches = [
        [(i, "a", i % 5, "TX" if i % 2 else "CA", float(i)) for i in range(40)] + [(90, "a", None, None, 1.0)],
        [(3, "b", 4, "CA", 8.0), (41, "b", 9, "NV", 2.0), (7, "a", 2, "TX", 7.0)],  # one moves, one is new, one stays
        [(90, "c", 1, "TX", 5.0), (41, "c", 9, "NV", 3.0)],
    ]
    cost = lambda df: cost_by_disaster(df, "disaster", "amount")
    prior = lambda df: prior_events(df.where("state IS NOT NULL"), "state", "t", "k")
    costs, counts, version = None, None, 0
    for i, batch in enumerate(batches):
        store.upsert(spark.createDataFrame(batch, shape))
        if compacted and i:
            store.compact()
        current, changes = store.read(), store.changes(version)
        if i == 1:
            found = {(r.change, r.k) for r in changes.collect()}
            assert found == {("after", 3), ("before", 3), ("after", 41)}
        costs = cost(current) if costs is None else refreshed(costs, current, changes, ["disaster"], cost)
        counts = prior(current) if counts is None else refreshed(counts, current, changes, ["state"], prior)
        version = store.log.snapshot().version
        assert contents(costs) == contents(cost(current))
        assert contents(counts) == contents(prior(current))
    assert store.changes(version).count() == 0
