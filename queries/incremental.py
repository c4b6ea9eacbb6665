"""Incremental merging, cursors and envelopes."""

import datetime
import uuid

from pyspark.sql import functions as F, types as T

from aftermath.operators import costs, cursors, merging
from aftermath.plans.refresh import refreshed
from aftermath.session import durable, shared_root
from aftermath.sources.store import KeyedStore
from aftermath.sources.tables import sizes, unwrap_records
from aftermath.spec import DatasetSpec
from aftermath.streaming import envelope
from queries.bindings import table
from queries.clean import TABLES

LINE = ["l_orderkey", "l_linenumber"]
VERSION = [*LINE, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus"]
TIE = ", ".join(f"{c} DESC NULLS LAST" for c in VERSION[3:])


def versions(spark, folder):
    """Line items as versioned records: the same line occurs several times."""
    return table(spark, folder, "lineitem").select(*VERSION, "l_returnflag")


def dedup_latest(spark, folder):
    return merging.keep_latest(versions(spark, folder).select(*VERSION), LINE, "l_shipdate")


def newest_sql(source: str, lead: str = "") -> str:
    return f"""(SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, {lead} {TIE}) AS rn FROM {source}) WHERE rn = 1)"""


ALL_SQL = f"(SELECT {', '.join(VERSION)} FROM lineitem)"
DEDUP_LATEST = f"SELECT * FROM {newest_sql(ALL_SQL)}"


def sides(spark, folder):
    """Stored lines are the open ones; the batch has all others and sends the unreturned open ones again."""
    rows = versions(spark, folder)
    stored = rows.where("l_linestatus = 'O'").select(*VERSION)
    return stored, rows.where("l_linestatus <> 'O' OR l_returnflag <> 'R'").select(*VERSION)


STORED_SQL = f"(SELECT {', '.join(VERSION)} FROM lineitem WHERE l_linestatus = 'O')"
INCOMING_SQL = f"(SELECT {', '.join(VERSION)} FROM lineitem WHERE l_linestatus <> 'O' OR l_returnflag <> 'R')"


def union_merge(spark, folder):
    """The batch has a column the stored rows lack."""
    stored, incoming = sides(spark, folder)
    wider = incoming.withColumn("l_note", F.concat(F.lit("p"), F.col("l_partkey").cast("string")))
    return merging.merge(stored, wider, LINE, "l_shipdate")


UNION_MERGE = f"""
SELECT * EXCLUDE (arrival) FROM {newest_sql(
    f"(SELECT *, 0 AS arrival, NULL AS l_note FROM {STORED_SQL} UNION ALL "
    f"SELECT *, 1 AS arrival, 'p' || l_partkey AS l_note FROM {INCOMING_SQL})", "arrival DESC,")}"""


def merge_report(spark, folder):
    stored, incoming = sides(spark, folder)
    return merging.merge_report("lines", stored, incoming, LINE)


MERGE_REPORT = f"""
SELECT 'lines' AS dataset, CAST(sum(CASE WHEN incoming = 0 THEN 1 ELSE 0 END) AS BIGINT) AS existing_rows,
       CAST(sum(incoming) AS BIGINT) AS new_rows,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates_removed,
       count(DISTINCT (l_orderkey, l_linenumber)) AS final_rows
FROM (SELECT *, 0 AS incoming FROM {STORED_SQL} UNION ALL SELECT *, 1 AS incoming FROM {INCOMING_SQL})"""


def changed_rows(spark, folder):
    stored, incoming = sides(spark, folder)
    current = merging.keep_latest(stored, LINE, "l_shipdate")
    return merging.classify(current, incoming, LINE, "l_shipdate").select(*LINE, "outcome")


CHANGED_ROWS = f"""
SELECT i.l_orderkey AS l_orderkey, i.l_linenumber AS l_linenumber,
       CASE WHEN e.l_orderkey IS NULL THEN 'new'
            WHEN (i.l_shipdate, i.l_partkey, i.l_suppkey, i.l_quantity, i.l_extendedprice, i.l_linestatus)
               = (e.l_shipdate, e.l_partkey, e.l_suppkey, e.l_quantity, e.l_extendedprice, e.l_linestatus) THEN 'unchanged'
            WHEN i.l_shipdate < e.l_shipdate THEN 'stale' ELSE 'updated' END AS outcome
FROM {newest_sql(INCOMING_SQL)} i LEFT JOIN {newest_sql(STORED_SQL)} e
     ON i.l_orderkey = e.l_orderkey AND i.l_linenumber = e.l_linenumber"""


def upsert(spark, folder):
    """Two upserts into a bucketed store, then a third that repeats the second."""
    root = f"{shared_root(spark)}/stores/{uuid.uuid4().hex}"
    store = KeyedStore(spark, root, "line_id", "l_shipdate", buckets=8)
    line_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id")
    stored, incoming = (side.select(line_id, *VERSION[2:]) for side in sides(spark, folder))
    store.upsert(stored)
    store.upsert(incoming)
    store.upsert(incoming)
    return store.read()


UPSERT = f"""
SELECT l_orderkey * 10 + l_linenumber AS line_id, {', '.join(VERSION[2:])}
FROM {newest_sql(f"(SELECT *, 0 AS arrival FROM {STORED_SQL} UNION ALL SELECT *, 1 AS arrival FROM {INCOMING_SQL})",
                 "arrival DESC,")}"""


def line_store(spark):
    return KeyedStore(spark, f"{shared_root(spark)}/stores/{uuid.uuid4().hex}", "line_id", "l_shipdate", buckets=8)


def line_batches(spark, folder):
    line_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id")
    return [side.select(line_id, *VERSION[2:]) for side in sides(spark, folder)]


def refreshed_totals(spark, folder):
    """Totals of each supplier after a first batch, brought up to date from the changes of a second one."""
    store = line_store(spark)
    stored, incoming = line_batches(spark, folder)
    totals = lambda df: costs.cost_by_disaster(df, "l_suppkey", "l_quantity")
    store.upsert(stored)
    version, before = store.log.snapshot().version, durable(totals(store.read()))
    store.upsert(incoming)
    after = refreshed(before, store.read(), store.changes(version), ["l_suppkey"], totals)
    return after.withColumn("avg_project_cost", F.round("avg_project_cost", 6))


REFRESHED_TOTALS = f"""
SELECT l_suppkey, sum(l_quantity) AS total_obligated_amount, count(l_quantity) AS project_count,
       round(avg(l_quantity), 6) AS avg_project_cost, max(l_quantity) AS max_project_cost
FROM ({UPSERT}) GROUP BY l_suppkey"""


def rows_after_mark(spark, folder):
    """Stored lines shipped after a mark, from the files that can hold some."""
    store = line_store(spark)
    stored, incoming = line_batches(spark, folder)
    store.upsert(stored)
    store.upsert(incoming)
    return store.rows_after(datetime.datetime(1998, 6, 1), 1000)


ROWS_AFTER_MARK = f"""
SELECT * FROM ({UPSERT}) WHERE l_shipdate > TIMESTAMP '1998-06-01' OR (l_shipdate = TIMESTAMP '1998-06-01' AND line_id > 1000)"""


def stored_keys(spark, folder):
    """All lines, and whether their key is in a store of the open ones; both searches open what can match."""
    store = line_store(spark)
    stored, _ = line_batches(spark, folder)
    store.upsert(stored)
    lines = versions(spark, folder).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), "l_shipdate")
    known, fresh = (store.known(lines), store.fresh(lines))
    return known.withColumn("stored", F.lit(True)).unionByName(fresh.withColumn("stored", F.lit(False)))


STORED_KEYS = """
SELECT l_orderkey * 10 + l_linenumber AS line_id, l_shipdate,
       (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_linestatus = 'O') AS stored
FROM lineitem"""


def semi_existing(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return merging.known_rows(table(spark, folder, "orders"), lines, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


SEMI_EXISTING = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)"


def anti_new(spark, folder):
    lines = table(spark, folder, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return merging.new_rows(table(spark, folder, "orders"), lines, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


ANTI_NEW = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"


def key_setops(spark, folder):
    left = table(spark, folder, "part").select(F.col("p_partkey").alias("key"))
    right = table(spark, folder, "orders").select(F.col("o_custkey").alias("key"))
    return merging.key_sets(left, right, ["key"])


KEY_SETOPS = """
SELECT coalesce(p, o) AS key, CASE WHEN p IS NULL THEN 'right' WHEN o IS NULL THEN 'left' ELSE 'both' END AS side
FROM (SELECT DISTINCT p_partkey AS p FROM part) FULL JOIN (SELECT DISTINCT o_custkey AS o FROM orders) ON p = o"""


def same_batches(spark, folder):
    """Whether the merged lines equal the newest of all lines, and a merge repeated equals itself."""
    stored, incoming = sides(spark, folder)
    merged = merging.merge(stored, incoming, LINE, "l_shipdate")
    again = merging.merge(merged, incoming, LINE, "l_shipdate")
    told = merging.compare_records(merged, again, dedup_latest(spark, folder))
    return told.select("n", F.col("same")[0].alias("replay_equal"), F.col("same")[1].alias("equals_all"))


SAME_BATCHES = f"""
WITH merged AS (SELECT * EXCLUDE (arrival) FROM {newest_sql(
    f"(SELECT *, 0 AS arrival FROM {STORED_SQL} UNION ALL SELECT *, 1 AS arrival FROM {INCOMING_SQL})", "arrival DESC,")})
SELECT count(*) AS n, TRUE AS replay_equal,
       NOT EXISTS (SELECT * FROM merged EXCEPT SELECT * FROM {newest_sql(ALL_SQL)})
       AND NOT EXISTS (SELECT * FROM {newest_sql(ALL_SQL)} EXCEPT SELECT * FROM merged) AS equals_all
FROM merged"""


def keyset_page(spark, folder):
    mark = F.lit("2024-01-10 12:00:00").cast("timestamp_ntz")
    page = cursors.keyset_page(table(spark, folder, "events"), "ts", "event_id", mark, 3000, 1000)
    return page.select("ts", "event_id", "user_id")


KEYSET_PAGE = """
SELECT ts, event_id, user_id FROM events
WHERE ts > TIMESTAMP '2024-01-10 12:00:00' OR (ts = TIMESTAMP '2024-01-10 12:00:00' AND event_id > 3000)
ORDER BY ts, event_id LIMIT 1000"""


def high_water_mark(spark, folder):
    marks = [
        cursors.high_water_mark(table(spark, folder, name), name, time, key)
        for name, time, key in (
            ("orders", "o_orderdate", "o_orderkey"),
            ("lineitem", "l_shipdate", "l_orderkey"),
            ("events", "ts", "event_id"),
        )
    ]
    return merging.union_by_name(*marks)


HIGH_WATER_MARK = " UNION ALL ".join(
    f"(SELECT '{name}' AS dataset, CAST({time} AS VARCHAR) AS last_refresh, CAST({key} AS VARCHAR) AS last_key "
    f"FROM {name} ORDER BY {time} DESC, {key} DESC LIMIT 1)"
    for name, time, key in (
        ("orders", "o_orderdate", "o_orderkey"),
        ("lineitem", "l_shipdate", "l_orderkey"),
        ("events", "ts", "event_id"),
    )
)

EVENTS = DatasetSpec(
    "events",
    "event_id",
    "ts",
    T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.StringType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
)


def event_records(spark, folder):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, folder, "events").withColumn("ts", stamp)


def envelope_roundtrip(spark, folder):
    sent = envelope.wrap(event_records(spark, folder), "events", EVENTS.columns)
    return envelope.records(durable(envelope.validate(sent, known=["events"])), EVENTS)


ENVELOPE_ROUNDTRIP = (
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"
)


def envelope_validate(spark, folder):
    """Events sent well formed or broken in one of five ways."""
    rows = event_records(spark, folder)
    key = F.col("event_id").cast("string")
    good = F.concat(F.lit('{"dataset":"events","payload":{"event_id":'), key, F.lit("}}"))
    sent = rows.select(
        "event_id",
        F.when(F.col("event_id") % 7 == 1, F.concat(F.lit("["), key, F.lit("]")))
        .when(F.col("event_id") % 7 == 2, F.concat(F.lit('{"payload":{"event_id":'), key, F.lit("}}")))
        .when(F.col("event_id") % 7 == 3, F.concat(F.lit('{"dataset":"other","payload":{"event_id":'), key, F.lit("}}")))
        .when(F.col("event_id") % 7 == 4, F.concat(F.lit('{"dataset":"events","payload":"{'), key, F.lit('}"}')))
        .when(F.col("event_id") % 7 == 5, F.concat(F.lit('{"dataset":"events",'), key))
        .otherwise(good)
        .alias("value"),
    )
    judged = envelope.validate(sent, known=["events"])
    return judged.select("event_id", "reason", F.to_json("payload").alias("payload"))


ENVELOPE_VALIDATE = """
SELECT event_id,
       CASE event_id % 7 WHEN 1 THEN 'not an object' WHEN 2 THEN 'missing dataset' WHEN 3 THEN 'unknown dataset'
                         WHEN 4 THEN 'payload is not an object' WHEN 5 THEN 'not an object' END AS reason,
       CASE WHEN event_id % 7 IN (0, 2, 3, 6) THEN '{"event_id":' || event_id || '}'
            WHEN event_id % 7 = 4 THEN '"{' || event_id || '}"' END AS payload
FROM events"""


def json_unwrap(spark, folder):
    """One API response per customer with two records each."""
    response = F.to_json(
        F.struct(
            F.struct(F.lit(0).alias("skip"), F.lit("customers").alias("entityname")).alias("metadata"),
            F.array(
                F.struct(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("name")),
                F.struct((-F.col("c_custkey")).alias("id"), F.col("c_name").alias("name")),
            ).alias("Customers"),
        )
    )
    shape = "metadata struct<skip:int,entityname:string>, Customers array<struct<id:bigint,name:string>>"
    landed = table(spark, folder, "customer").select(F.from_json(response, shape).alias("r")).select("r.*")
    return unwrap_records(landed)


JSON_UNWRAP = """
SELECT c_custkey AS id, c_mktsegment AS name FROM customer UNION ALL SELECT -c_custkey, c_name FROM customer"""


def dataset_stats(spark, folder):
    parts = [
        sizes(table(spark, folder, name)).select(
            F.lit(name).alias("dataset"), "rows", "files", (F.col("megabytes") >= 0).cast("int").alias("sized")
        )
        for name in TABLES
    ]
    return merging.union_by_name(*parts)


DATASET_STATS = " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS rows, 1::BIGINT AS files, CAST(1 AS INT) AS sized FROM {name}" for name in TABLES
)

QUERIES = {
    "dedup_latest": (dedup_latest, DEDUP_LATEST),
    "union_merge": (union_merge, UNION_MERGE),
    "merge_report": (merge_report, MERGE_REPORT),
    "changed_rows": (changed_rows, CHANGED_ROWS),
    "upsert": (upsert, UPSERT),
    "refreshed_totals": (refreshed_totals, REFRESHED_TOTALS),
    "rows_after_mark": (rows_after_mark, ROWS_AFTER_MARK),
    "stored_keys": (stored_keys, STORED_KEYS),
    "semi_existing": (semi_existing, SEMI_EXISTING),
    "anti_new": (anti_new, ANTI_NEW),
    "key_setops": (key_setops, KEY_SETOPS),
    "same_batches": (same_batches, SAME_BATCHES),
    "keyset_page": (keyset_page, KEYSET_PAGE),
    "high_water_mark": (high_water_mark, HIGH_WATER_MARK),
    "envelope_roundtrip": (envelope_roundtrip, ENVELOPE_ROUNDTRIP),
    "envelope_validate": (envelope_validate, ENVELOPE_VALIDATE),
    "json_unwrap": (json_unwrap, JSON_UNWRAP),
    "dataset_stats": (dataset_stats, DATASET_STATS),
}
