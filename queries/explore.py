"""Exploratory summaries."""

from pyspark.sql import functions as F

from aftermath.functions import dates
from aftermath.operators import costs, explore, features
from queries.bindings import DECLARATIONS_SQL, KINDS, declarations, table, with_ctes

AS_OF = "2001-09-01 00:00:00"


def timed(spark, folder):
    """Declarations with whole-day duration, begin year and season."""
    as_of = F.lit(AS_OF).cast("timestamp_ntz")
    return declarations(spark, folder).withColumns(
        {
            "duration": dates.whole_days(F.col("incidentbegindate"), F.col("incidentenddate"), as_of),
            "begin_year": F.year("incidentbegindate").cast("int"),
            "season": dates.season(F.month("incidentbegindate")),
        }
    )


TIMED_SQL = f"""
timed AS (
  SELECT *, greatest(CAST(floor(date_diff('microsecond', incidentbegindate, coalesce(incidentenddate, TIMESTAMP '{AS_OF}'))
                          / 86400000000.0) AS BIGINT), 1) AS duration,
         CAST(year(incidentbegindate) AS INT) AS begin_year,
         CASE WHEN month(incidentbegindate) IN (12, 1, 2) THEN 'Winter' WHEN month(incidentbegindate) IN (3, 4, 5) THEN 'Spring'
              WHEN month(incidentbegindate) IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END AS season
  FROM decl
)"""
CTES = (DECLARATIONS_SQL, TIMED_SQL)
OTHER_KINDS = f", count(*) FILTER (WHERE coalesce(incidenttype NOT IN ({', '.join(repr(k) for k in KINDS)}), TRUE)) AS other"


def value_counts(spark, folder):
    return explore.value_counts(timed(spark, folder), ["state", "incidenttype", "declarationtype", "season"])


VALUE_COUNTS = with_ctes(
    " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM timed GROUP BY {c}"
        for c in ("state", "incidenttype", "declarationtype", "season")
    ),
    *CTES,
)


def crosstab_season(spark, folder):
    return explore.crosstab(timed(spark, folder), "season", "incidenttype", KINDS)


CROSSTAB_SEASON = with_ctes(
    " SELECT season, "
    + ", ".join(f"count(*) FILTER (WHERE incidenttype = '{kind}') AS \"{kind}\"" for kind in KINDS)
    + OTHER_KINDS
    + " FROM timed GROUP BY season",
    *CTES,
)


def season_share(spark, folder):
    shares = explore.row_shares(timed(spark, folder), "season", "incidenttype")
    return shares.withColumn("share", F.round("share", 6))


SEASON_SHARE = with_ctes(
    """
SELECT season, incidenttype, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY season), 6) AS share
FROM timed GROUP BY season, incidenttype""",
    *CTES,
)


def topk_states(spark, folder):
    """State x type counts of the ten states with most declarations."""
    rows = timed(spark, folder)
    top = features.top_labels(rows, "state", 10).select("state")
    return explore.crosstab(rows.join(top, "state", "left_semi"), "state", "incidenttype", KINDS)


TOPK_STATES = with_ctes(
    " SELECT state, "
    + ", ".join(f"count(*) FILTER (WHERE incidenttype = '{kind}') AS \"{kind}\"" for kind in KINDS)
    + OTHER_KINDS
    + " FROM timed WHERE state IN (SELECT state FROM timed GROUP BY 1 ORDER BY count(*) DESC, state LIMIT 10) GROUP BY state",
    *CTES,
)


def preagg_join(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice", "l_returnflag"
    )
    joined = costs.cost_before_join(
        table(spark, folder, "orders").select("o_orderkey", "o_orderdate"),
        lines,
        "o_orderkey",
        "l_extendedprice",
        "l_returnflag",
    )
    return joined.withColumn("total_obligated", F.round("total_obligated", 2))


PREAGG_JOIN = """
SELECT o_orderkey, o_orderdate, round(coalesce(total, 0), 2) AS total_obligated, coalesce(n, 0) AS project_count,
       u AS unique_categories
FROM orders LEFT JOIN (SELECT l_orderkey, sum(l_extendedprice) AS total, count(l_returnflag) AS n,
                              count(DISTINCT l_returnflag) AS u FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey"""


def state_risk(spark, folder):
    rows = declarations(spark, folder).select("id", "state")
    return explore.group_size(rows, "state", "historical_disaster_count_per_state")


STATE_RISK = with_ctes(
    " SELECT id, state, count(*) OVER (PARTITION BY state) AS historical_disaster_count_per_state FROM decl",
    DECLARATIONS_SQL,
)


def duration_eda(spark, folder):
    return timed(spark, folder).select("id", "duration", "season")


DURATION_EDA = with_ctes(" SELECT id, duration, season FROM timed", *CTES)


def avg_duration_year(spark, folder):
    means = explore.mean_by(timed(spark, folder), "begin_year", "duration", "mean_duration")
    return means.withColumn("mean_duration", F.round("mean_duration", 6))


AVG_DURATION_YEAR = with_ctes(
    " SELECT begin_year, round(avg(duration), 6) AS mean_duration FROM timed GROUP BY begin_year", *CTES
)

DESCRIBED = ("mean", "std", "min", "max", *explore.QUARTILES)


def describe(spark, folder):
    summary = explore.describe(table(spark, folder, "lineitem"), "l_extendedprice")
    return summary.select("n", *[F.round(c, 4).alias(c) for c in DESCRIBED])


def describe_sql(value: str) -> str:
    return f"""count({value}) AS n, round(avg({value}), 4) AS mean, round(stddev_samp({value}), 4) AS std,
       round(CAST(min({value}) AS DOUBLE), 4) AS min, round(CAST(max({value}) AS DOUBLE), 4) AS max,
       round(quantile_cont({value}, 0.25), 4) AS q25, round(quantile_cont({value}, 0.5), 4) AS q50,
       round(quantile_cont({value}, 0.75), 4) AS q75"""


DESCRIBE = f"SELECT {describe_sql('l_extendedprice')} FROM lineitem"


def describe_by_type(spark, folder):
    summary = explore.describe(timed(spark, folder), "duration", ["incidenttype"])
    return summary.select("incidenttype", "n", *[F.round(c, 4).alias(c) for c in DESCRIBED])


DESCRIBE_BY_TYPE = with_ctes(
    f" SELECT incidenttype, {describe_sql('duration')} FROM timed GROUP BY incidenttype", *CTES
)


def profile(spark, folder):
    return explore.profile(table(spark, folder, "orders"))


PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls, "
    f"count(DISTINCT {c}) AS distinct_values, '{kind}' AS type FROM orders"
    for c, kind in (
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"),
        ("o_orderpriority", "string"),
    )
)


def histogram(spark, folder):
    bins = explore.histogram(timed(spark, folder), "duration")
    return bins.withColumn("bin_start", F.round("bin_start", 6))


HISTOGRAM = with_ctes(
    """,
ends AS (SELECT CAST(min(duration) AS DOUBLE) AS low, CAST(max(duration) AS DOUBLE) AS high FROM timed),
counted AS (
  SELECT CAST(least(floor((duration - low) * 40 / (high - low)), 39) AS INT) AS bin, count(*) AS n
  FROM timed, ends GROUP BY 1
)
SELECT CAST(f.b AS INT) AS bin, round(low + f.b * ((high - low) / 40), 6) AS bin_start, coalesce(n, 0) AS n
FROM range(40) f(b) CROSS JOIN ends LEFT JOIN counted ON counted.bin = f.b""",
    *CTES,
)


def boxplot_stats(spark, folder):
    """Box-plot numbers of the duration for the six most frequent types."""
    rows = timed(spark, folder)
    top = features.top_labels(rows, "incidenttype", 6).select("incidenttype")
    return explore.box_numbers(rows.join(top, "incidenttype", "left_semi"), "incidenttype", "duration")


BOXPLOT_STATS = with_ctes(
    """,
kept AS (SELECT incidenttype, duration FROM timed
         WHERE incidenttype IN (SELECT incidenttype FROM timed GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6)),
boxes AS (SELECT incidenttype, quantile_cont(duration, 0.25) AS q25, quantile_cont(duration, 0.5) AS q50,
                 quantile_cont(duration, 0.75) AS q75 FROM kept GROUP BY 1)
SELECT kept.incidenttype AS incidenttype, count(*) AS n, min(q25) AS q25, min(q50) AS q50, min(q75) AS q75,
       CAST(min(duration) FILTER (WHERE duration BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS DOUBLE) AS whisker_low,
       CAST(max(duration) FILTER (WHERE duration BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS DOUBLE) AS whisker_high,
       count(*) FILTER (WHERE duration NOT BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS outliers
FROM kept JOIN boxes ON kept.incidenttype = boxes.incidenttype GROUP BY 1""",
    *CTES,
)

QUERIES = {
    "value_counts": (value_counts, VALUE_COUNTS),
    "crosstab_season": (crosstab_season, CROSSTAB_SEASON),
    "season_share": (season_share, SEASON_SHARE),
    "topk_states": (topk_states, TOPK_STATES),
    "preagg_join": (preagg_join, PREAGG_JOIN),
    "state_risk": (state_risk, STATE_RISK),
    "duration_eda": (duration_eda, DURATION_EDA),
    "avg_duration_year": (avg_duration_year, AVG_DURATION_YEAR),
    "describe": (describe, DESCRIBE),
    "describe_by_type": (describe_by_type, DESCRIBE_BY_TYPE),
    "profile": (profile, PROFILE),
    "histogram": (histogram, HISTOGRAM),
    "boxplot_stats": (boxplot_stats, BOXPLOT_STATS),
}
