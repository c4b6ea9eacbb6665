"""Cleaning, scalar functions and cost aggregation."""

from pyspark.sql import functions as F

from aftermath.functions import dates, lookups, text
from aftermath.operators import cleaning, costs, features
from queries.bindings import (
    DECLARATIONS_SQL,
    PROJECTS_SQL,
    SUMMARIES_SQL,
    declarations,
    projects,
    summaries,
    table,
    with_ctes,
)

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def scan_counts(spark, folder):
    parts = [
        table(spark, folder, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in TABLES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


SCAN_COUNTS = " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {name}" for name in TABLES)


def raw_county_rows(spark, folder):
    """Several declarations per (applicant, state), dates as ISO text, some unreadable or missing."""
    rows = declarations(spark, folder)
    stamp = F.date_format("declarationdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.select(
        F.col("id"),
        F.when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.col("applicant")).alias(" disasterNumber"),
        F.col("state"),
        F.col("declarationtype").alias("declarationType"),
        F.when(F.col("id") % 13 == 0, "unknown").otherwise(stamp).alias("declarationDate "),
        F.date_format("declarationdate", "yyyy-MM").alias("lastRefresh"),
    )


def clean_declarations(spark, folder):
    clean = cleaning.clean_declarations(raw_county_rows(spark, folder))
    return clean.select(
        "id", "disasternumber", "state", "declarationtype", F.col("declarationdate").cast("date").alias("declared_on")
    )


CLEAN_DECLARATIONS = with_ctes(
    """
SELECT id, applicant AS disasternumber, state, declarationtype, CAST(declarationdate AS DATE) AS declared_on
FROM (SELECT *, row_number() OVER (PARTITION BY applicant, state
                                   ORDER BY strftime(declarationdate, '%Y-%m'), id) AS rn
      FROM decl WHERE id % 97 <> 0 AND id % 13 <> 0 AND declarationtype IN ('DR', 'EM', 'FM'))
WHERE rn = 1""",
    DECLARATIONS_SQL,
)


def text_norm(spark, folder):
    padded = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(F.col("c_custkey") % 9 != 0, F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "))).alias("segment"),
    )
    return cleaning.tidy_text_columns(padded, ["segment"]).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


TEXT_NORM = """
SELECT CASE WHEN c_custkey % 9 <> 0 THEN upper(c_mktsegment) END AS segment, count(*) AS n
FROM customer GROUP BY 1"""


def distinct_rows(spark, folder):
    return table(spark, folder, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber").distinct()


DISTINCT_ROWS = "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem"


def rounded_cost(df, *extra):
    return df.select(
        "disasternumber",
        F.round("total_obligated_amount", 2).alias("total_obligated_amount"),
        "project_count",
        F.round("avg_project_cost", 6).alias("avg_project_cost"),
        "max_project_cost",
        *[F.round(c, 2).alias(c) for c in extra],
    )


def pa_aggregate(spark, folder):
    return rounded_cost(costs.cost_by_disaster(cleaning.clean_projects(projects(spark, folder))))


COST_COLUMNS = """disasternumber, round(sum(amount), 2) AS total_obligated_amount, count(amount) AS project_count,
       round(avg(amount), 6) AS avg_project_cost, max(amount) AS max_project_cost"""

PA_AGGREGATE = with_ctes(f" SELECT {COST_COLUMNS} FROM projects GROUP BY disasternumber", PROJECTS_SQL)


def pa_category_pivot(spark, folder):
    usable = cleaning.clean_projects(projects(spark, folder))
    names = costs.category_names(usable, "damagecategorycode")
    cost = costs.cost_by_disaster(usable, category="damagecategorycode", categories=names, rest="cat_cost_other")
    return rounded_cost(cost, *[f"cat_cost_{name}" for name in names], "cat_cost_other")


PA_CATEGORY_PIVOT = with_ctes(
    f"""
SELECT {COST_COLUMNS},
       round(sum(CASE WHEN category = 'A' THEN amount ELSE 0 END), 2) AS "cat_cost_A",
       round(sum(CASE WHEN category = 'N' THEN amount ELSE 0 END), 2) AS "cat_cost_N",
       round(sum(CASE WHEN category = 'R' THEN amount ELSE 0 END), 2) AS "cat_cost_R",
       round(sum(CASE WHEN category NOT IN ('A', 'N', 'R') THEN amount ELSE 0 END), 2) AS cat_cost_other
FROM projects GROUP BY disasternumber""",
    PROJECTS_SQL,
)


def summary_totals(spark, folder):
    doubled = summaries(spark, folder).unionByName(
        summaries(spark, folder).withColumn("lastRefresh", F.lit("9999"))
    )
    return cleaning.clean_summaries(doubled)


SUMMARY_TOTALS = with_ctes(
    " SELECT disasternumber, reported AS summary_total_obligations FROM summaries", SUMMARIES_SQL
)


def region_severity(spark, folder):
    return declarations(spark, folder).select(
        "id",
        lookups.region_of(F.col("state")).alias("region"),
        F.round(lookups.type_severity(F.col("incidenttype")), 6).alias("type_severity"),
    )


# Fixed values, written out here once more so that the table under test is checked.
REGION_CASE = """CASE
    WHEN state IN ('CT', 'MA', 'ME', 'NH', 'NJ', 'NY', 'PA', 'RI', 'VT') THEN 'Northeast'
    WHEN state IN ('IA', 'IL', 'IN', 'KS', 'MI', 'MN', 'MO', 'ND', 'NE', 'OH', 'SD', 'WI') THEN 'Midwest'
    WHEN state IN ('AL', 'AR', 'DC', 'DE', 'FL', 'GA', 'KY', 'LA', 'MD', 'MS', 'NC', 'OK', 'SC', 'TN', 'TX', 'VA', 'WV') THEN 'South'
    WHEN state IN ('AK', 'AZ', 'CA', 'CO', 'HI', 'ID', 'MT', 'NM', 'NV', 'OR', 'UT', 'WA', 'WY') THEN 'West'
    ELSE 'Other' END"""
SEVERITY_CASE = (
    "CASE incidenttype WHEN 'Hurricane' THEN 1.0 WHEN 'Flood' THEN 0.75 WHEN 'Tornado' THEN 0.75 "
    "WHEN 'Severe Storm' THEN 0.5 WHEN 'Severe Ice Storm' THEN 0.5 WHEN 'Fire' THEN 0.5 WHEN 'Drought' THEN 0.25 "
    "WHEN 'Snowstorm' THEN 0.25 WHEN 'Biological' THEN 0.75 WHEN 'Dam/Levee Break' THEN 1.0 "
    "WHEN 'Typhoon' THEN 1.0 WHEN 'Coastal Storm' THEN 0.5 ELSE 0.0 END"
)
REGION_SEVERITY = with_ctes(
    f" SELECT id, {REGION_CASE} AS region, CAST({SEVERITY_CASE} AS DOUBLE) AS type_severity FROM decl",
    DECLARATIONS_SQL,
)


def calendar_features(spark, folder):
    dated = dates.calendar_parts(declarations(spark, folder).select("id", "declarationdate"), "declarationdate")
    return dated.select(
        "id",
        *[F.col(f"declaration_{c}").cast("int").alias(f"declaration_{c}") for c in ("year", "month", "quarter")],
        F.dayofyear("declarationdate").cast("int").alias("dayofyear"),
        *[
            F.round(f"declaration_{c}", 6).alias(f"declaration_{c}")
            for c in ("month_sin", "month_cos", "quarter_sin", "quarter_cos")
        ],
    )


CALENDAR_FEATURES = with_ctes(
    """
SELECT id, CAST(year(declarationdate) AS INT) AS declaration_year, CAST(month(declarationdate) AS INT) AS declaration_month,
       CAST(quarter(declarationdate) AS INT) AS declaration_quarter, CAST(dayofyear(declarationdate) AS INT) AS dayofyear,
       round(sin(month(declarationdate) * 2 * pi() / 12), 6) AS declaration_month_sin,
       round(cos(month(declarationdate) * 2 * pi() / 12), 6) AS declaration_month_cos,
       round(sin(quarter(declarationdate) * 2 * pi() / 4), 6) AS declaration_quarter_sin,
       round(cos(quarter(declarationdate) * 2 * pi() / 4), 6) AS declaration_quarter_cos
FROM decl""",
    DECLARATIONS_SQL,
)


def durations(spark, folder):
    timed = features.incident_times(
        declarations(spark, folder), "declarationdate", "incidentbegindate", "incidentenddate"
    )
    return timed.select(
        "id",
        F.round("incident_duration_days", 6).alias("incident_duration_days"),
        F.round("days_to_declaration", 6).alias("days_to_declaration"),
    )


DURATION_SQL = "coalesce(greatest(date_diff('microsecond', {0}, {1}) / 86400000000.0, 0.0), 0.0)"
DURATIONS = with_ctes(
    f"""
SELECT id, round(CASE WHEN incidentenddate IS NULL THEN 0.0 ELSE {DURATION_SQL.format('incidentbegindate', 'incidentenddate')} END, 6)
         AS incident_duration_days,
       round({DURATION_SQL.format('incidentbegindate', 'declarationdate')}, 6) AS days_to_declaration
FROM decl""",
    DECLARATIONS_SQL,
)


def fips_key(spark, folder):
    """Codes as they arrive: numbers, padded text, over-long text, junk and null."""
    key = F.col("l_partkey")
    raw = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(key % 17 == 0, F.lit(None)).otherwise(F.concat(F.floor(key / 1000).cast("string"), F.lit(".0"))).alias("state_code"),
        F.when(key % 19 == 0, "n/a").when(key % 23 == 0, (key + 1000).cast("string")).otherwise((key % 1000).cast("string")).alias("county_code"),
    )
    keyed = raw.withColumn("place", text.place_key(F.col("state_code"), F.col("county_code")))
    return keyed.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_part"))


FIPS_KEY = """
SELECT CASE WHEN l_partkey % 17 = 0 OR l_partkey % 19 = 0 THEN NULL
            ELSE CASE WHEN l_partkey // 1000 < 10 THEN '0' ELSE '' END || CAST(l_partkey // 1000 AS VARCHAR) ||
                 CASE WHEN l_partkey % 23 = 0 THEN CAST(l_partkey + 1000 AS VARCHAR)
                      ELSE right('00' || CAST(l_partkey % 1000 AS VARCHAR), 3) END END AS place,
       count(*) AS n, min(l_partkey) AS first_part
FROM lineitem GROUP BY 1"""


def two_digit_year(spark, folder):
    """Ship dates written as ``28-APR-96 14:30:00`` and read back."""
    written = F.when(F.col("l_linenumber") == 7, "31-FEB-96 10:00:00").otherwise(
        F.upper(F.date_format("l_shipdate", "dd-MMM-yy HH:mm:ss"))
    )
    read = dates.two_digit_year_timestamp(F.col("written"))
    return (
        table(spark, folder, "lineitem")
        .select(written.alias("written"))
        .select(read.cast("date").alias("day"))
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("n"))
    )


TWO_DIGIT_YEAR = """
SELECT CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS day, count(*) AS n FROM lineitem GROUP BY 1"""


QUERIES = {
    "scan_counts": (scan_counts, SCAN_COUNTS),
    "clean_declarations": (clean_declarations, CLEAN_DECLARATIONS),
    "text_norm": (text_norm, TEXT_NORM),
    "distinct_rows": (distinct_rows, DISTINCT_ROWS),
    "pa_aggregate": (pa_aggregate, PA_AGGREGATE),
    "pa_category_pivot": (pa_category_pivot, PA_CATEGORY_PIVOT),
    "summary_totals": (summary_totals, SUMMARY_TOTALS),
    "region_severity": (region_severity, REGION_SEVERITY),
    "calendar_features": (calendar_features, CALENDAR_FEATURES),
    "durations": (durations, DURATIONS),
    "fips_key": (fips_key, FIPS_KEY),
    "two_digit_year": (two_digit_year, TWO_DIGIT_YEAR),
}
