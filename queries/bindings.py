"""Stand-ins for the raw tables, built from the test tables in Spark and in SQL.

Every function reads whole tables. The SQL fragments are the same definitions
written independently for the comparison engine.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# One postal code per nation; two are territories outside the census regions.
STATES = (
    "AK AL AZ CA CO FL GA IA IL KS LA MA ME MN MO NC NJ NY OH PR TX VT WA WV GU".split()
)
# One is not in the severity table.
KINDS = (
    "Hurricane",
    "Flood",
    "Tornado",
    "Severe Storm",
    "Severe Ice Storm",
    "Fire",
    "Drought",
    "Snowstorm",
    "Biological",
    "Dam/Levee Break",
    "Typhoon",
    "Volcanic Eruption",
    "Coastal Storm",
)


_schemas: dict = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table; calendar arithmetic is in UTC. The schema is read off the file once."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{folder}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def pick(labels, index: Column) -> Column:
    """The label at a 0-based index."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), (index + 1).cast("int"))


def sql_list(labels) -> str:
    return "[" + ", ".join("'" + label + "'" for label in labels) + "]"


def declarations(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer's nation as dated declarations of a state."""
    key = F.col("o_orderkey")
    begin = F.col("o_orderdate") - F.make_dt_interval(days=(key % 30).cast("int"), hours=(key % 24).cast("int"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, folder, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("id"),
            key.alias("disasternumber"),
            F.col("o_custkey").alias("applicant"),
            pick(STATES, F.col("c_nationkey")).alias("state"),
            pick(KINDS, (F.col("o_custkey") * 3 + key) % 37 % 13).alias("incidenttype"),
            F.when(F.col("o_orderstatus") == "F", "DR")
            .when(F.col("o_orderstatus") == "O", "EM")
            .otherwise("FS")
            .alias("declarationtype"),
            F.col("o_orderdate").alias("declarationdate"),
            begin.alias("incidentbegindate"),
            F.when(key % 7 != 0, begin + F.make_dt_interval(days=(key % 45).cast("int"))).alias("incidentenddate"),
            F.col("o_custkey").alias("place"),
        )
    )


DECLARATIONS_SQL = f"""
decl AS (
  SELECT o_orderkey AS id, o_orderkey AS disasternumber, o_custkey AS applicant,
         ({sql_list(STATES)})[c_nationkey + 1] AS state,
         ({sql_list(KINDS)})[CAST((o_custkey * 3 + o_orderkey) % 37 % 13 AS INT) + 1] AS incidenttype,
         CASE o_orderstatus WHEN 'F' THEN 'DR' WHEN 'O' THEN 'EM' ELSE 'FS' END AS declarationtype,
         o_orderdate AS declarationdate,
         o_orderdate - (o_orderkey % 30) * INTERVAL 1 DAY - (o_orderkey % 24) * INTERVAL 1 HOUR AS incidentbegindate,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate - (o_orderkey % 30) * INTERVAL 1 DAY
              - (o_orderkey % 24) * INTERVAL 1 HOUR + (o_orderkey % 45) * INTERVAL 1 DAY END AS incidentenddate,
         o_custkey AS place
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def storm_events(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as storm events at a place, some windy and some floods."""
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("place"),
        (F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))).alias("event_begin"),
        F.col("l_orderkey").alias("event_order"),
        F.col("l_linenumber").alias("event_line"),
        F.col("l_quantity").alias("magnitude"),
        F.when(F.col("l_returnflag") == "A", "EG").alias("magnitude_type"),
        F.when(F.col("l_returnflag") == "R", "Flash Flood").otherwise("Hail").alias("event_type"),
    )


STORM_EVENTS_SQL = """
storms AS (
  SELECT l_partkey AS place, l_shipdate + l_linenumber * INTERVAL 1 HOUR AS event_begin,
         l_orderkey AS event_order, l_linenumber AS event_line, l_quantity AS magnitude,
         l_returnflag = 'A' AS is_wind, l_returnflag = 'R' AS is_flood
  FROM lineitem
)"""


def readings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as daily station readings in the archive's raw form."""
    supplier = F.col("l_suppkey")
    return table(spark, folder, "lineitem").select(
        F.concat(F.when(supplier % 10 == 0, "CA").otherwise("US"), F.lpad(supplier.cast("string"), 9, "0")).alias("ID"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("DATE"),
        F.when(F.col("l_returnflag") == "N", "SNOW").otherwise("PRCP").alias("ELEMENT"),
        F.when(F.col("l_linenumber") == 7, -9999).otherwise(F.col("l_quantity") * 10 + F.col("l_linenumber")).cast("long").alias("VALUE"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stations of a state."""
    supplier = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        F.concat(F.when(supplier % 10 == 0, "CA").otherwise("US"), F.lpad(supplier.cast("string"), 9, "0")).alias("ID"),
        F.concat(F.lit(" "), F.lower(pick(STATES, F.col("s_nationkey")))).alias("STATE"),
    )


DAILY_SQL = f"""
daily AS (
  SELECT ({sql_list(STATES)})[s_nationkey + 1] AS state, CAST(l_shipdate AS DATE) AS day,
         max((CAST(l_quantity * 10 + l_linenumber AS BIGINT)) / 10.0) AS precip_mm
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  WHERE l_returnflag <> 'N' AND l_linenumber <> 7 AND l_suppkey % 10 <> 0
  GROUP BY 1, 2
)"""


def projects(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as funded projects; amounts arrive as text, some unusable."""
    amount = F.col("l_extendedprice").cast("string")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("disasterNumber"),
        F.when(F.col("l_linenumber") == 5, "n/a")
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("-"), amount))
        .otherwise(amount)
        .alias("federalShareObligated"),
        F.col("l_returnflag").alias("damageCategoryCode"),
    )


PROJECTS_SQL = """
projects AS (
  SELECT l_orderkey AS disasternumber, l_extendedprice AS amount, l_returnflag AS category
  FROM lineitem WHERE l_linenumber NOT IN (5, 6) AND l_extendedprice > 0
)"""


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as reported totals; every eleventh reports 0."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("disasterNumber"),
        F.when(F.col("o_orderkey") % 11 == 0, 0.0).otherwise(F.col("o_totalprice")).alias("totalObligatedAmountPa"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("lastRefresh"),
    )


SUMMARIES_SQL = """
summaries AS (
  SELECT o_orderkey AS disasternumber, CASE WHEN o_orderkey % 11 = 0 THEN 0.0 ELSE o_totalprice END AS reported
  FROM orders
)"""


def with_ctes(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + body
