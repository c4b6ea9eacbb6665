"""Merging, classification, the keyed store and the staged ingest."""

import json
import random

import pytest
from pyspark.sql import functions as F

from aftermath.operators import cursors, merging
from aftermath.plans import ingest
from aftermath.sources import archives, tables
from aftermath.sources.store import KeyedStore
from aftermath.spec import DISASTER_SUMMARIES, PUBLIC_ASSISTANCE

SHAPE = "k long, t string, v string"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SHAPE)


def contents(df):
    return sorted((tuple(r) for r in df.select("k", "t", "v").collect()), key=repr)


def test_latest_is_idempotent_and_order_free(spark):
    rows = [(i % 7, f"2020-01-{i % 5 + 1:02d}", f"v{i}") for i in range(60)]
    first = merging.keep_latest(frame(spark, *rows), ["k"], "t")
    again = merging.keep_latest(first, ["k"], "t")
    random.Random(1).shuffle(rows)
    shuffled = merging.keep_latest(frame(spark, *rows).repartition(5), ["k"], "t")
    assert contents(first) == contents(again) == contents(shuffled) and first.count() == 7


def test_equal_cursor_goes_to_the_later_arrival(spark):
    merged = merging.merge(frame(spark, (1, "a", "zzz")), frame(spark, (1, "a", "new"), (2, None, "x")), ["k"], "t")
    assert contents(merged) == [(1, "a", "new"), (2, None, "x")]


def test_classification(spark):
    stored = frame(spark, (1, "b", "x"), (2, "b", None), (3, "b", "x"), (4, "b", "x"))
    batch = frame(spark, (1, "c", "y"), (2, "b", None), (3, "a", "y"), (5, "a", "x"), (4, "b", "other"))
    got = {r.k: r.outcome for r in merging.classify(stored, batch, ["k"], "t").collect()}
    assert got == {1: "updated", 2: "unchanged", 3: "stale", 4: "updated", 5: "new"}


def test_same_records_and_key_sets(spark):
    left = frame(spark, (1, None, "x"), (1, None, "x"))
    assert merging.same_records(left, left) and not merging.same_records(left, left.distinct())
    sides = merging.key_sets(frame(spark, (1, "", ""), (2, "", "")), frame(spark, (2, "", ""), (3, "", "")), ["k"])
    assert {r.k: r.side for r in sides.collect()} == {1: "left", 2: "both", 3: "right"}


def test_merge_report(spark):
    row = merging.merge_report("d", frame(spark, (1, "", ""), (2, "", "")), frame(spark, (2, "", ""), (2, "", ""), (3, "", "")), ["k"]).head()
    assert (row.existing_rows, row.new_rows, row.duplicates_removed, row.final_rows) == (2, 3, 2, 3)


def test_keyset_pages_visit_every_row_once(spark):
    rows = frame(spark, *[(i, f"t{i // 4}", "") for i in range(23)])
    seen, mark = [], (None, None)
    while True:
        page = cursors.keyset_page(rows, "t", "k", *mark, 5).collect()
        if not page:
            break
        seen += [r.k for r in page]
        mark = (page[-1].t, page[-1].k)
    assert seen == list(range(23))


def test_mark_covers_all_rows_not_the_last_page(spark):
    mark = cursors.high_water_mark(frame(spark, (9, "2020-02", ""), (10, "2020-02", ""), (1, "2020-01", "")), "d", "t", "k").head()
    assert (mark.last_refresh, mark.last_key) == ("2020-02", "10")


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path / "store"), "k", "t", buckets=4)


def test_upsert_outcomes_and_replay(spark, store):
    assert store.read() is None and store.mark() is None
    first = store.upsert(frame(spark, *[(i, "2020-01", f"v{i}") for i in range(20)], (3, "2020-00", "old")))
    assert (first["new"], first["duplicates"]) == (20, 1)
    batch = frame(spark, (1, "2020-02", "changed"), (2, "2020-01", "v2"), (3, "2019-01", "stale"), (99, "2020-01", "fresh"), (None, "2020-01", "lost"))
    second = store.upsert(batch)
    assert (second["updated"], second["unchanged"], second["stale"], second["new"], second["without_key"]) == (1, 1, 1, 1, 1)
    assert second["buckets_rewritten"] <= 2
    state = contents(store.read())
    version = store.log.snapshot().version
    assert store.upsert(batch)["buckets_rewritten"] == 0
    assert contents(store.read()) == state and store.log.snapshot().version == version
    assert store.mark() == ("2020-02", "1")
    assert (1, "2020-02", "changed") in state and (3, "2020-01", "v3") in state and len(state) == 21


def test_only_touched_buckets_move(spark, store):
    store.upsert(frame(spark, *[(i, "a", "x") for i in range(40)]))
    before = store.log.snapshot().buckets
    store.upsert(frame(spark, (7, "b", "y")))
    after = store.log.snapshot().buckets
    moved = [b for b in after if after[b] != before.get(b)]
    assert len(moved) == 1 and store.read().count() == 40


def test_new_columns_are_null_in_untouched_rows(spark, store):
    store.upsert(frame(spark, *[(i, "a", "x") for i in range(10)]))
    store.upsert(frame(spark, (3, "b", "y")).withColumn("extra", F.lit("e")))
    got = {r.k: r.extra for r in store.read().collect()}
    assert got[3] == "e" and got[4] is None and len(got) == 10


def test_data_without_a_commit_is_not_read(spark, store):
    store.upsert(frame(spark, (1, "a", "x")))
    stray = store.bucketed(frame(spark, (1, "z", "stray"), (2, "z", "stray")))
    stray.write.partitionBy("bucket").parquet(f"{store.root}/data/v=2")
    assert contents(store.read()) == [(1, "a", "x")]
    store.upsert(frame(spark, (1, "b", "y")))
    assert contents(store.read()) == [(1, "b", "y")]


def test_another_number_of_buckets_is_refused(spark, store):
    store.upsert(frame(spark, (1, "a", "x")))
    other = KeyedStore(spark, store.root, "k", "t", buckets=8)
    with pytest.raises(ValueError, match="4 buckets"):
        other.upsert(frame(spark, (1, "b", "y")))


def test_replaced_versions_can_be_discarded(spark, store):
    store.upsert(frame(spark, *[(i, "a", "x") for i in range(40)]))
    store.upsert(frame(spark, (7, "b", "y")))
    before = contents(store.read())
    assert store.discard_replaced() == 0  # a delta replaces nothing
    assert store.compact() == 1
    assert store.discard_replaced() == 2 and store.discard_replaced() == 0
    assert contents(store.read()) == before


def test_numeric_keys_order_as_numbers_in_the_mark(spark, store):
    store.upsert(frame(spark, (9, "a", "x")))
    store.upsert(frame(spark, (10, "a", "x")))
    assert store.mark() == ("a", "10")


def project(spark, *rows):
    return spark.createDataFrame(list(rows), "gmProjectId long, disasterNumber long, federalShareObligated double, lastRefresh string")


def test_staged_runs_merge_once(spark, tmp_path):
    root = str(tmp_path)
    assert ingest.merge_staged(spark, root, PUBLIC_ASSISTANCE) == []
    ingest.stage(project(spark, (1, 1, 5.0, "2020-01"), (2, 1, 6.0, "2020-03")), root, PUBLIC_ASSISTANCE, "r1", 0)
    ingest.stage(project(spark, (3, 1, 7.0, "2020-02")), root, PUBLIC_ASSISTANCE, "r1", 1)
    ingest.stage(project(spark, (3, 1, 7.0, "2020-02")), root, PUBLIC_ASSISTANCE, "r1", 1)  # the page is fetched again
    report = ingest.merge_staged(spark, root, PUBLIC_ASSISTANCE, buckets=2)
    assert [r["new"] for r in report] == [3]
    assert ingest.merge_staged(spark, root, PUBLIC_ASSISTANCE, buckets=2) == []
    ingest.stage(project(spark, (1, 1, 9.0, "2020-04")), root, PUBLIC_ASSISTANCE, "r2", 0)
    ingest.merge_staged(spark, root, PUBLIC_ASSISTANCE, buckets=2)
    stats = ingest.statistics(spark, root, PUBLIC_ASSISTANCE)
    assert (stats["rows"], stats["mark"]) == (3, ("2020-04", "1"))


def test_landed_json_is_unwrapped_and_conformed(spark, tmp_path):
    page = {"metadata": {"skip": 0}, "Summaries": [{"disasterNumber": "12", "totalObligatedAmountPa": 5}, {"disasterNumber": 13, "note": "x"}]}
    (tmp_path / "p.json").write_text(json.dumps(page))
    got = tables.read_landed_json(spark, str(tmp_path / "p.json"), DISASTER_SUMMARIES)
    assert sorted((r.disasterNumber, r.totalObligatedAmountPa) for r in got.collect()) == [(12, 5.0), (13, None)]
    (tmp_path / "q.json").write_text('{"metadata": {"skip": 0}, "Summaries": [{"disasterNumber"')
    with pytest.raises(Exception):
        tables.read_landed_json(spark, str(tmp_path / "*.json"), DISASTER_SUMMARIES).collect()
    rejects = str(tmp_path / "rejects")
    assert tables.read_landed_json(spark, str(tmp_path / "*.json"), DISASTER_SUMMARIES, rejects).count() == 2
    assert [r.path.endswith("q.json") for r in spark.read.json(rejects).collect()] == [True]
    (tmp_path / "none.json").write_text('{"metadata": {"skip": 9}, "Summaries": []}')
    empty = tables.read_landed_json(spark, str(tmp_path / "none.json"), DISASTER_SUMMARIES)
    assert empty.columns == DISASTER_SUMMARIES.columns and empty.count() == 0
    with pytest.raises(ValueError, match="no list"):
        tables.unwrap_records(spark.range(1))


def test_landed_pages_may_differ_in_fields_and_are_rejected_whole(spark, tmp_path):
    pages = {
        "a": {"count": 2, "Names": ["x"], "Rows": [{" DisasterNumber": 1, "totalObligatedAmountPa": None}, {"id": "k"}]},
        "b": {"Rows": [{"disasterNumber": "2.0", "totalObligatedAmountPa": "7.5", "nested": {"u": [1]}}]},
        "c": {"Rows": [{"disasterNumber": 3}, 4]},
        "d": {"Names": ["x"]},
        "e": [1, 2],
        "f": {"Rows": [], "Names": []},
    }
    for name, page in pages.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(page, indent=1))
    (tmp_path / "g.json").write_text(" ")
    (tmp_path / "h.json").write_text("")
    rejects = str(tmp_path / "rejects")
    got = tables.read_landed_json(spark, str(tmp_path / "*.json"), DISASTER_SUMMARIES, rejects).collect()
    assert {(r.disasterNumber, r.totalObligatedAmountPa, r.id) for r in got} == {(1, None, None), (None, None, "k"), (2, 7.5, None)}
    why = {r.path.rsplit("/", 1)[1][0]: r.reason for r in spark.read.json(rejects).collect()}
    assert {name: reason.split()[0] for name, reason in why.items()} == {"c": "a", "d": "no", "e": "no", "g": "not"}
    with pytest.raises(Exception, match="no list of records"):
        tables.read_landed_json(spark, str(tmp_path / "d.json"), DISASTER_SUMMARIES).count()


def test_datasets_load_empty_when_absent(spark, tmp_path):
    assert tables.load_dataset(spark, str(tmp_path), DISASTER_SUMMARIES).count() == 0
    project(spark, (1, 1, 5.0, "a")).write.parquet(str(tmp_path / "public_assistance.parquet"))
    loaded = tables.load_dataset(spark, str(tmp_path), PUBLIC_ASSISTANCE)
    assert loaded.columns == PUBLIC_ASSISTANCE.columns and loaded.head().gmProjectId == 1


def test_archive_readers(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "2001.csv.gz", "wt") as out:
        out.write("US1,20010105,PRCP,25,,,S,0700\nUS1,20010106,TMAX,25,,,S,\n")
    with gzip.open(tmp_path / "2002.csv.gz", "wt") as out:
        out.write("US1,20020105,PRCP,30,,,S,0700\n")
    assert archives.read_readings(spark, str(tmp_path)).count() == 3
    assert archives.read_readings(spark, str(tmp_path), years=[2002, 2003], spread=2).head().VALUE == 30
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write("EPISODE, cz_type ,STATE_FIPS,CZ_FIPS,BEGIN_DATE_TIME,EVENT_TYPE,MAGNITUDE\n1,C,48,1,28-APR-96 14:30:00,Hail,1.5\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write("CZ_TYPE,STATE_FIPS,CZ_FIPS,BEGIN_DATE_TIME,END_DATE_TIME,EVENT_TYPE,MAGNITUDE,MAGNITUDE_TYPE\nC,48,3,29-APR-96 14:30:00,30-APR-96 14:30:00,Hail,2,EG\n")
    events = archives.read_storm_files(spark, [str(tmp_path / "a.csv.gz"), str(tmp_path / "b.csv.gz")])
    assert sorted((r.CZ_FIPS, r.MAGNITUDE, r.MAGNITUDE_TYPE) for r in events.collect()) == [("1", "1.5", None), ("3", "2", "EG")]
    assert not any(".csv" in path for path in events.inputFiles())  # the archives are read once
    assert archives.read_storm_files(spark, []).count() == 0
    (tmp_path / "c.csv.gz").write_bytes(b"not gzip at all")
    (tmp_path / "empty.csv").write_text("")
    mixed = [str(tmp_path / name) for name in ("c.csv.gz", "empty.csv", "absent.csv.gz", "a.csv.gz")]
    assert archives.read_storm_files(spark, mixed).count() == 1
    with gzip.open(tmp_path / "long.csv.gz", "wt") as out:
        out.write("CZ_TYPE,STATE_FIPS,CZ_FIPS\n" + "".join(f"C,48,{(k * 7919) % 997}\n" for k in range(20000)))
    whole = (tmp_path / "long.csv.gz").read_bytes()
    (tmp_path / "cut.csv.gz").write_bytes(whole[: len(whole) // 2])
    rejects = str(tmp_path / "rejects")
    assert archives.read_storm_files(spark, [str(tmp_path / "cut.csv.gz"), *mixed], rejects).count() == 1
    refused = {r.path.rsplit("/", 1)[1]: r.reason for r in spark.read.json(rejects).collect()}
    assert set(refused) == {"cut.csv.gz", "c.csv.gz", "empty.csv", "absent.csv.gz"} and all(refused.values())
    line = "US000000001  12.5000 -101.5000   30.5 TX SOMEWHERE NAME                "
    (tmp_path / "stations.txt").write_text(line + "\n")
    station = archives.read_stations(spark, str(tmp_path / "stations.txt")).head()
    assert (station.ID, station.LATITUDE, station.STATE, station.NAME) == ("US000000001", 12.5, "TX", "SOMEWHERE NAME")


def test_sizes(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(str(tmp_path / "t"))
    row = tables.sizes(spark.read.parquet(str(tmp_path / "t"))).head()
    assert (row.rows, row.files) == (100, 3)


def test_a_null_cursor_is_older_and_an_added_column_counts(spark):
    stored = spark.createDataFrame([(1, "2024", "good"), (2, "2024", "same")], "id long, c string, v string")
    batch = spark.createDataFrame([(1, None, "bad", None), (2, "2024", "same", 5)], "id long, c string, v string, extra long")
    got = {r.id: r.outcome for r in merging.classify(stored, batch, ["id"], "c").collect()}
    assert got == {1: merging.STALE, 2: merging.UPDATED}
    assert not merging.same_records(stored, batch.select("id", "c", "v", "extra"))


def test_compare_records_of_several_sides(spark):
    left = frame(spark, (1, None, "x"), (1, None, "x"), (2, "t", "y"))
    wider = left.withColumn("more", F.lit(None).cast("string"))
    row = merging.compare_records(left, left, left.distinct(), wider, wider.fillna("z", ["more"]), left.limit(0)).head()
    assert (row.n, row.same) == (3, [True, False, True, False, False])
    empty = merging.compare_records(left.limit(0), left.limit(0)).head()
    assert (empty.n, empty.same) == (0, [True])


def test_merged_sides_are_compared_where_they_lie(spark):
    stored = spark.range(60).select(F.col("id").alias("k"), F.lit(1).alias("t"), (F.col("id") % 7).alias("v"))
    batch = spark.range(30, 90).select(F.col("id").alias("k"), F.lit(2).alias("t"), (F.col("id") % 5).alias("v"))
    merged = merging.merge(stored, batch, ["k"], "t")
    newest = merging.keep_latest(stored.unionByName(batch), ["k"], "t")
    told = merging.compare_records(merged, merging.merge(merged, batch, ["k"], "t"), newest, stored)
    told_plan = merging.compare_records(merged, merging.merge(merged, batch, ["k"], "t"), newest)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in told_plan.splitlines() if "Exchange hashpartitioning" in line]
    # each merge and the newest rows by key; none for the comparison
    assert dealt and not any("v#" in line.split("hashpartitioning(")[1].split(")")[0] for line in dealt), dealt
    row = told.head()
    assert (row.n, row.same) == (90, [True, True, False])
