"""Archives, landed pages, staged runs and the stream, written to the shared folder from the test tables and read back."""

import uuid

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F, types as T

from aftermath.operators import explore
from aftermath.operators.cleaning import clean_storm_events, county_declarations, exclude_kind
from aftermath.plans import ingest as staging, training
from aftermath.session import shared_root
from aftermath.sources import archives, tables
from aftermath.spec import DECLARATIONS, DatasetSpec
from aftermath.streaming import envelope, ingest as streaming
from queries.bindings import DECLARATIONS_SQL, declarations, readings, table, with_ctes
from queries.incremental import INCOMING_SQL, STORED_SQL, VERSION, newest_sql, sides


def scratch(spark, name):
    return f"{shared_root(spark)}/{name}/{uuid.uuid4().hex}"


def storm_archive(spark, folder):
    """Line items as yearly archives: narratives with quotes and line breaks; even years lack the magnitude type."""
    root = scratch(spark, "storms")
    stamp = F.upper(F.date_format(F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber")), "dd-MMM-yy HH:mm:ss"))
    rows = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").alias("STATE_FIPS"),
        F.when(F.col("l_linestatus") == "O", "C").otherwise("Z").alias("CZ_TYPE"),
        (F.col("l_partkey") % 1000).alias("CZ_FIPS"),
        stamp.alias("BEGIN_DATE_TIME"),
        F.concat(F.lit('hail, "'), "l_orderkey", F.lit('"\nthen left')).alias("EPISODE_NARRATIVE"),
        stamp.alias("END_DATE_TIME"),
        F.when(F.col("l_returnflag") == "R", "Flash Flood").otherwise("Hail").alias("EVENT_TYPE"),
        F.col("l_quantity").alias("MAGNITUDE"),
        F.when(F.col("l_returnflag") == "A", "EG").alias("MAGNITUDE_TYPE"),
        F.year("l_shipdate").alias("year"),
    )
    for name, some in (("odd", rows.where("year % 2 = 1")), ("even", rows.where("year % 2 = 0").drop("MAGNITUDE_TYPE"))):
        some.write.options(header=True, escape='"', compression="gzip").partitionBy("year").csv(f"{root}/{name}")
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/year=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    events = clean_storm_events(archives.read_storm_files(spark, sorted(f.getPath().toString() for f in found)))
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("event_begin", "event_end")}
    return events.withColumns(times)


STORM_ARCHIVE = """
SELECT lpad(CAST(l_linenumber AS VARCHAR), 2, '0') || lpad(CAST(l_partkey % 1000 AS VARCHAR), 3, '0') AS place,
       strftime(l_shipdate + l_linenumber * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS event_begin,
       strftime(l_shipdate + l_linenumber * INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS event_end,
       CASE WHEN l_returnflag = 'R' THEN 'Flash Flood' ELSE 'Hail' END AS event_type, l_quantity AS magnitude,
       CASE WHEN year(l_shipdate) % 2 = 1 AND l_returnflag = 'A' THEN 'EG' END AS magnitude_type
FROM lineitem WHERE l_linestatus = 'O'"""


def readings_archive(spark, folder):
    """Readings as headerless yearly archives of eight columns."""
    root = scratch(spark, "readings")
    rows = readings(spark, folder).withColumns({c: F.lit(None).cast("string") for c in ("MFLAG", "QFLAG", "SFLAG", "OBSTIME")})
    for (year,) in rows.select(F.substring("DATE", 1, 4)).distinct().collect():  # one row a year
        rows.where(F.col("DATE").startswith(year)).write.option("compression", "gzip").csv(f"{root}/{year}.csv.gz")
    return archives.read_readings(spark, root, spread=8)


READINGS_ARCHIVE = """
SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'CA' ELSE 'US' END || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS ID,
       strftime(l_shipdate, '%Y%m%d') AS DATE, CASE WHEN l_returnflag = 'N' THEN 'SNOW' ELSE 'PRCP' END AS ELEMENT,
       CAST(CASE WHEN l_linenumber = 7 THEN -9999 ELSE l_quantity * 10 + l_linenumber END AS BIGINT) AS VALUE
FROM lineitem"""

CUSTOMERS = DatasetSpec(
    "customers", "id", "name", T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
)


def landed_json(spark, folder):
    """Customers as landed API pages of at most 500 records, their keys sent as text."""
    root = scratch(spark, "landed")
    record = F.struct(F.concat("c_custkey", F.lit(".0")).alias("id"), F.col("c_name").alias("name"))
    pages = table(spark, folder, "customer").groupBy(F.expr("c_custkey div 500").alias("page")).agg(
        F.to_json(F.struct(F.struct(F.lit(0).alias("skip")).alias("metadata"), F.collect_list(record).alias("Customers"))).alias("value")
    )
    # one row a page, so one file a page
    pages.write.partitionBy("page").text(root)
    return tables.read_landed_json(spark, root, CUSTOMERS)


LANDED_JSON = "SELECT c_custkey AS id, c_name AS name FROM customer"

LINES = DatasetSpec(
    "lines",
    "line_id",
    "l_shipdate",
    T.StructType(
        [
            T.StructField("line_id", T.LongType()),
            T.StructField("l_shipdate", T.TimestampNTZType()),
            T.StructField("l_partkey", T.LongType()),
            T.StructField("l_suppkey", T.LongType()),
            T.StructField("l_quantity", T.DoubleType()),
            T.StructField("l_extendedprice", T.DoubleType()),
            T.StructField("l_linestatus", T.StringType()),
        ]
    ),
)


def staged_merge(spark, folder):
    """Two runs of two pages each, staged and merged once; a second merge finds nothing to do."""
    root = scratch(spark, "staged")
    line_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id")
    for run, side in zip(("2024-01-01", "2024-01-02"), sides(spark, folder)):
        for page in (0, 1):
            staging.stage(side.where(F.col("l_suppkey") % 2 == page).select(line_id, *VERSION[2:]), root, LINES, run, page)
    reports = staging.merge_staged(spark, root, LINES, 8) + staging.merge_staged(spark, root, LINES, 8)
    removed = staging.discard_merged(spark, root, LINES)
    merged = staging.store_of(spark, root, LINES, 8).read()
    return merged.withColumns({"runs_merged": F.lit(len(reports)), "runs_removed": F.lit(len(removed))})


STAGED_MERGE = f"""
SELECT l_orderkey * 10 + l_linenumber AS line_id, {', '.join(VERSION[2:])}, 2 AS runs_merged, 2 AS runs_removed
FROM {newest_sql(f"(SELECT *, 0 AS run, l_suppkey % 2 AS page FROM {STORED_SQL} UNION ALL "
                 f"SELECT *, 1 AS run, l_suppkey % 2 AS page FROM {INCOMING_SQL})", "run DESC, page DESC,")}"""

SENT = ["id", "disasterNumber", "state", "incidentType", "declarationType", "lastRefresh"]


def stream_upsert(spark, folder):
    """Declarations as a stream of envelopes, every third sent anew, every fifth once more in an old version, every seventh also broken."""
    root = scratch(spark, "stream")
    rows = declarations(spark, folder).select(
        F.col("id").cast("string").alias("id"),
        F.col("disasternumber").alias("disasterNumber"),
        "state",
        F.col("incidenttype").alias("incidentType"),
        F.col("declarationtype").alias("declarationType"),
    )
    number = F.col("disasterNumber")
    sent = rows.withColumn("lastRefresh", F.lit("2024-01-01T00:00:00.000Z"))
    newer = rows.where(number % 3 == 0).withColumns({"state": F.lit("ZZ"), "lastRefresh": F.lit("2024-02-01T00:00:00.000Z")})
    older = rows.where(number % 5 == 0).withColumns({"state": F.lit("XX"), "lastRefresh": F.lit("2023-01-01T00:00:00.000Z")})
    values = envelope.wrap(sent.unionByName(newer).unionByName(older), DECLARATIONS.name, SENT, F.col("lastRefresh"))
    broken = rows.where(number % 7 == 0).select(F.concat(F.lit("["), "id", F.lit("]")).alias("value"))
    # the number of files only makes several micro-batches
    values.unionByName(broken).repartition(6).write.text(f"{root}/landing")
    stream = streaming.envelopes(spark, f"{root}/landing", files_per_batch=2)
    streaming.run(stream, root, f"{root}/offsets", buckets=8).awaitTermination()
    seen = streaming.run_metrics(spark, root).agg(F.sum("records").alias("records"), F.sum("bad").alias("bad")).first()
    stored = staging.store_of(spark, root, DECLARATIONS, 8).read()
    return stored.select(*SENT, F.lit(seen.records).cast("long").alias("records"), F.lit(seen.bad).cast("long").alias("bad"))


STREAM_UPSERT = with_ctes(
    """
SELECT CAST(id AS VARCHAR) AS id, disasternumber AS "disasterNumber", CASE WHEN id % 3 = 0 THEN 'ZZ' ELSE state END AS state,
       incidenttype AS "incidentType", declarationtype AS "declarationType",
       CASE WHEN id % 3 = 0 THEN '2024-02-01T00:00:00.000Z' ELSE '2024-01-01T00:00:00.000Z' END AS "lastRefresh",
       (SELECT CAST(count(*) + count(*) FILTER (id % 3 = 0) + count(*) FILTER (id % 5 = 0)
                    + count(*) FILTER (id % 7 = 0) AS BIGINT) FROM decl) AS records,
       (SELECT count(*) FILTER (id % 7 = 0) FROM decl) AS bad
FROM decl""",
    DECLARATIONS_SQL,
)


def run_snapshot(spark, folder):
    """Order counts written for two run dates; the first date is then run again and replaced."""
    root = scratch(spark, "runs")
    orders = table(spark, folder, "orders")

    def counted(rows):
        return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))

    tables.write_run(counted(orders.where("o_orderkey % 2 = 0")), root, "2024-01-01")
    tables.write_run(counted(orders), root, "2024-01-02")
    tables.write_run(counted(orders.where("o_orderkey % 2 = 1")), root, "2024-01-01")
    day = F.date_format("event_timestamp", "yyyy-MM-dd").alias("event_day")
    return spark.read.parquet(root).select("o_orderstatus", "n", day, F.col("run_date").cast("string").alias("run_date"))


RUN_SNAPSHOT = """
SELECT o_orderstatus, count(*) AS n, '2024-01-01' AS event_day, '2024-01-01' AS run_date
FROM orders WHERE o_orderkey % 2 = 1 GROUP BY o_orderstatus
UNION ALL
SELECT o_orderstatus, count(*), '2024-01-02', '2024-01-02' FROM orders GROUP BY o_orderstatus"""


def linear_baseline(spark, folder):
    """A linear model of one feature: extended price by quantity."""
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice")
    fitted = training.pipeline(["l_quantity"], LinearRegression(labelCol="l_extendedprice", solver="normal")).fit(rows)
    line = fitted.stages[-1]
    return rows.agg(F.count(F.lit(1)).alias("n")).select(
        "n",
        F.round(F.lit(float(line.coefficients[0])), 4).alias("slope"),
        F.round(F.lit(float(line.intercept)), 4).alias("intercept"),
    )


LINEAR_BASELINE = """
SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem"""



def loaded_dataset(spark, folder):
    """Declarations landed with other names and types and loaded as the registered dataset; exposures are absent."""
    root = scratch(spark, "processed")
    rows = declarations(spark, folder).select(
        F.col("id").alias(" ID"),
        F.concat("disasternumber", F.lit(".0")).alias("disasternumber"),
        F.col("state").alias("STATE"),
        F.col("applicant").alias("not_in_the_dataset"),
    )
    rows.write.parquet(f"{root}/{DECLARATIONS.name}.parquet")
    loaded = tables.load_dataset(spark, root, DECLARATIONS)
    storms = tables.load(spark, f"{root}/storm_exposure.parquet", tables.STORM_SCHEMA)
    gates = [explore.quality_gate(frame, DECLARATIONS.columns)["ok"] for frame in (loaded, tables.load_dataset(spark, root, CUSTOMERS))]
    both = loaded.join(storms, loaded["disasterNumber"] == storms["disasternumber"], "left")
    return both.select(
        "id", loaded["disasterNumber"].alias("number"), "state", "lastRefresh", "storm_event_count",
        *(F.lit(ok).alias(name) for ok, name in zip(gates, ("usable", "absent_usable"))),
    )


LOADED_DATASET = with_ctes(
    """
SELECT CAST(id AS VARCHAR) AS id, disasternumber AS number, state, CAST(NULL AS VARCHAR) AS "lastRefresh",
       CAST(NULL AS BIGINT) AS storm_event_count, TRUE AS usable, FALSE AS absent_usable
FROM decl""",
    DECLARATIONS_SQL,
)


def county_windows(spark, folder):
    """Declarations of every kind but one, three county rows each, as distinct (disaster, place, begin, end) for weather matching."""
    kind = F.when(F.col("id") % 10 != 0, F.col("incidenttype")).alias("incidentType")
    rows = declarations(spark, folder).select(
        F.concat("disasternumber", F.lit(".0")).alias("disasterNumber"),
        kind,
        F.when(F.col("id") % 13 != 0, (F.col("place") % 56).cast("string")).alias("fipsStateCode"),
        (F.col("place") % 1000).alias("_county"),
        F.date_format("incidentbegindate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("incidentBeginDate"),
        F.date_format("incidentenddate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("incidentEndDate"),
    )
    counties = F.explode(F.array(*(((F.col("_county") + shift) % 1000).cast("string") for shift in (0, 0, 7))))
    found = county_declarations(exclude_kind(rows.withColumn("fipsCountyCode", counties), "incidentType", "Biological"))
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("incidentbegindate", "incidentenddate")}
    return found.withColumns(times)


COUNTY_WINDOWS = with_ctes(
    """
SELECT DISTINCT disasternumber,
       lpad(CAST(place % 56 AS VARCHAR), 2, '0') || lpad(CAST((place % 1000 + shift) % 1000 AS VARCHAR), 3, '0') AS place,
       strftime(incidentbegindate, '%Y-%m-%d %H:%M:%S') AS incidentbegindate,
       strftime(incidentenddate, '%Y-%m-%d %H:%M:%S') AS incidentenddate
FROM decl, (VALUES (0), (0), (7)) AS shifts(shift)
WHERE id % 13 <> 0 AND (id % 10 = 0 OR incidenttype <> 'Biological')""",
    DECLARATIONS_SQL,
)

QUERIES = {
    "loaded_dataset": (loaded_dataset, LOADED_DATASET),
    "county_windows": (county_windows, COUNTY_WINDOWS),
    "storm_archive": (storm_archive, STORM_ARCHIVE),
    "readings_archive": (readings_archive, READINGS_ARCHIVE),
    "landed_json": (landed_json, LANDED_JSON),
    "staged_merge": (staged_merge, STAGED_MERGE),
    "stream_upsert": (stream_upsert, STREAM_UPSERT),
    "run_snapshot": (run_snapshot, RUN_SNAPSHOT),
    "linear_baseline": (linear_baseline, LINEAR_BASELINE),
}
