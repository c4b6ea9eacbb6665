"""Deltas, compaction, concurrent writers, written states of the log, batches applied once."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from aftermath import session
from aftermath.sources import store as stores
from aftermath.sources.store import CommitConflict, CommitLog, KeyedStore


def opened(spark, tmp_path, buckets=8):
    return KeyedStore(spark, str(tmp_path / "store"), "k", "t", buckets=buckets)


def rows(spark, first, last, t, step=1):
    return spark.range(first, last, step).select(
        F.col("id").alias("k"), F.lit(t).alias("t"), F.sha2(F.concat_ws("-", "id", F.lit(t)), 512).alias("v")
    )


def size(store):
    return sum(f.stat().st_size for f in Path(store.root, "data").rglob("*.parquet"))


def contents(df):
    return sorted(map(tuple, df.collect()))


def test_a_small_batch_writes_little_and_reads_as_a_full_rewrite(spark, tmp_path):
    store = opened(spark, tmp_path)
    store.upsert(rows(spark, 0, 40_000, "a"))
    before = size(store)
    report = store.upsert(rows(spark, 0, 40_000, "b", 100))
    assert report["updated"] == 400 and report["buckets_rewritten"] == 8
    assert size(store) - before < 0.03 * before
    store.upsert(rows(spark, 39_900, 40_100, "c"))
    want = contents(rows(spark, 0, 39_900, "a").where("k % 100 <> 0").unionByName(rows(spark, 0, 39_900, "b", 100)).unionByName(rows(spark, 39_900, 40_100, "c")))
    assert contents(store.read()) == want
    assert store.compact() == 8 and store.compact() == 0
    assert contents(store.read()) == want
    assert all(len(folders) == 1 for folders in store.log.snapshot().buckets.values())
    assert store.upsert(rows(spark, 0, 100, "a"))["stale"] == 1 and store.mark() == ("c", "40099")


def test_many_deltas_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stores, "MOST_DELTAS", 2)
    store = opened(spark, tmp_path, 1)
    for i, t in enumerate("abcde"):
        store.upsert(rows(spark, i, 10, t))
        assert len(store.log.snapshot().buckets[0]) <= 3
    assert [r.t for r in store.read().orderBy("k").collect()] == list("abcd") + ["e"] * 6


def between(store, monkeypatch, action):
    """Runs ``action`` once, after the next upsert of ``store`` has judged its rows and before it commits."""
    honest = KeyedStore._written

    def written(self, frame, version):
        folder = honest(self, frame, version)
        monkeypatch.setattr(KeyedStore, "_written", honest)
        action()
        return folder

    monkeypatch.setattr(KeyedStore, "_written", written)


def test_interleaved_writers_lose_nothing(spark, tmp_path, monkeypatch):
    one, other = opened(spark, tmp_path), opened(spark, tmp_path)
    one.upsert(rows(spark, 0, 50, "a"))
    # the same keys: the later writer judges anew, and the newer version stays
    between(one, monkeypatch, lambda: other.upsert(rows(spark, 0, 50, "c")))
    report = one.upsert(rows(spark, 0, 60, "b"))
    assert (report["stale"], report["new"]) == (50, 10)
    assert contents(one.read()) == contents(rows(spark, 0, 50, "c").unionByName(rows(spark, 50, 60, "b")))
    # different buckets: both commits stand without a new attempt
    where = {r.bucket: r.k for r in one.bucketed(rows(spark, 100, 200, "a")).collect()}
    (_, k1), (_, k2) = sorted(where.items())[:2]
    between(one, monkeypatch, lambda: other.upsert(rows(spark, k2, k2 + 1, "z")))
    version = one.log.snapshot().version
    one.upsert(rows(spark, k1, k1 + 1, "y"))
    assert one.log.snapshot().version == version + 2 and {k1, k2} <= {r.k for r in one.read().collect()}
    # a compaction that meets a writer leaves its buckets alone
    between(one, monkeypatch, lambda: other.upsert(rows(spark, 0, 60, "zz")))
    assert one.compact() == 0 and one.read().where("t = 'zz'").count() == 60


def test_a_version_is_written_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    entry = {"layout": spark.range(1).schema.json(), "width": 1}
    assert log.append(0, entry, [("base", 0, "x")]) == 1
    assert log.append(0, entry, [("base", 1, "y")]) == 2
    with pytest.raises(CommitConflict):
        log.append(0, entry, [("delta", 1, "z")])
    with pytest.raises(CommitConflict):
        log.append(1, {**entry, "layout": spark.range(1).selectExpr("id AS other").schema.json()}, [("base", 5, "z")])
    assert log.snapshot().buckets == {0: ("x",), 1: ("y",)} and os.listdir(tmp_path / "log" / "open") == []


def test_a_long_log_is_read_from_its_written_state(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"), every=100)
    entry = {"layout": spark.createDataFrame([], "k string, t string").schema.json(), "width": 4}
    for i in range(250):
        kind = "base" if i < 4 or i % 50 == 0 else "delta"
        log.append(i, {**entry, "source": f"run{i}", "mark_time": f"{i:04d}", "mark_key": str(i), "stream": "s", "batch": i, "report": f'{{"n": {i}}}'}, [(kind, i % 4, f"f{i}")])
    last, files = log.sources_of_state()
    assert last == 200 and len(files) == 50
    state = log.snapshot()
    assert state.version == 250 and state.width == 4
    for bucket in range(4):
        own = [i for i in range(250) if i % 4 == bucket]
        base = max(i for i in own if i < 4 or i % 50 == 0)
        assert state.buckets[bucket] == tuple(f"f{i}" for i in own if i >= base)
    assert log.sources().count() == 250
    assert log.report_of("s", 249) == {"n": 249} and log.report_of("s", 199) == {"n": 199} and log.report_of("s", 250) is None
    assert log.rows().count() < 600 + 250


def test_a_batch_is_applied_once(spark, tmp_path):
    store = opened(spark, tmp_path)
    first = store.upsert(rows(spark, 0, 20, "a"), batch=("stream", 4))
    assert store.upsert(rows(spark, 0, 20, "a"), batch=("stream", 4)) == first and first["new"] == 20
    assert store.upsert(rows(spark, 0, 20, "a"), batch=("other", 4))["unchanged"] == 20


def test_tasks_follow_the_rows_of_a_search(spark, tmp_path, monkeypatch):
    """The partitions of a search are as many as its rows ask for, and its results stay the same."""
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    monkeypatch.setattr(stores, "TASK_ROWS", 100)
    store = stores.KeyedStore(spark, f"{tmp_path}/dealt", "k", "t", buckets=2)
    rows = spark.range(2000).select(F.col("id").alias("k"), F.lit(1).alias("t"), (F.col("id") % 7).alias("v"))
    assert store.upsert(rows)["new"] == 2000
    assert store.upsert(rows.where("k >= 1500").withColumns({"t": F.lit(2), "v": F.lit(9).cast("long")}))["updated"] == 500
    assert store.log.snapshot().rows() == 2500
    sought = spark.range(1000, 3000).withColumnRenamed("id", "k")
    known, fresh = store.known(sought), store.fresh(sought)
    for found in (known, fresh):  # 2,500 stored rows and 2,000 sought ones
        assert ", 45), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert (known.count(), known.agg(F.max("k")).head()[0]) == (1000, 1999)
    assert (fresh.count(), fresh.agg(F.min("k")).head()[0]) == (1000, 2000)
    assert (store.read().count(), store.read().where("v = 9").count()) == (2000, 500)


def test_wide_rows_are_dealt_out_over_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    narrow = spark.range(1000).withColumn("v", F.lit("x"))
    wide = narrow.withColumns({f"c{i}": F.lit("x") for i in range(23)})
    assert session.dealt(narrow, ["id"], 1000).rdd.getNumPartitions() == 10
    assert session.dealt(wide, ["id"], 1000).rdd.getNumPartitions() >= 60
    assert session.dealt(wide, ["id"], 10).rdd.getNumPartitions() == wide.rdd.getNumPartitions()


def test_the_only_delta_of_a_bucket_is_read_without_ranking_its_rows(spark, tmp_path):
    store = opened(spark, tmp_path)
    store.upsert(rows(spark, 0, 1_000, "a"))
    store.upsert(rows(spark, 500, 1_500, "b"))
    got = store.read()
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert contents(got) == contents(rows(spark, 0, 500, "a").unionByName(rows(spark, 500, 1_500, "b")))
    # buckets with one delta beside such with several
    store.upsert(rows(spark, 700, 703, "c"))
    assert {len(f) for f in store.log.snapshot().buckets.values()} == {2, 3}
    want = rows(spark, 0, 500, "a").unionByName(rows(spark, 500, 1_500, "b").where("k NOT BETWEEN 700 AND 702"))
    assert contents(store.read()) == contents(want.unionByName(rows(spark, 700, 703, "c")))


def test_a_large_batch_is_not_read_once_more_to_choose_stored_rows(spark, tmp_path, monkeypatch):
    store = opened(spark, tmp_path)
    store.upsert(rows(spark, 0, 1_000, "b"))
    chosen = []
    honest = stores.merging.known_rows
    monkeypatch.setattr(stores.merging, "known_rows", lambda *a: chosen.append(1) or honest(*a))
    store.upsert(rows(spark, 0, 10, "a"))
    assert chosen
    chosen.clear()
    monkeypatch.setattr(stores, "FEW_KEYS", 10)
    batch = rows(spark, 900, 950, "a").unionByName(rows(spark, 950, 1_000, "b")).unionByName(rows(spark, 1_000, 1_200, "c"))
    report = store.upsert(batch.unionByName(rows(spark, 0, 100, "d")))
    assert not chosen
    assert (report["stale"], report["unchanged"], report["new"], report["updated"]) == (50, 50, 200, 100)
