"""Feature columns and the feature table."""

from pyspark.sql import functions as F

from aftermath.functions import lookups
from aftermath.operators import cleaning, costs, features
from aftermath.plans import features as plan
from aftermath.session import durable
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
from queries.clean import DURATION_SQL, REGION_CASE, SEVERITY_CASE
from queries.match import CLIMATE_CTES, climate


def state_frequency(spark, folder):
    counted = features.prior_events(
        declarations(spark, folder).select("state", "declarationdate", "disasternumber"),
        "state",
        "declarationdate",
        "disasternumber",
    )
    return counted.select("disasternumber", "state", "state_disaster_frequency")


STATE_FREQUENCY = with_ctes(
    """
SELECT disasternumber, state,
       row_number() OVER (PARTITION BY state ORDER BY declarationdate, disasternumber) - 1 AS state_disaster_frequency
FROM decl""",
    DECLARATIONS_SQL,
)


def region_code(spark, folder):
    regions = features.state_region(declarations(spark, folder).select("id", "state"), "state")
    coded = features.category_code(regions, "region", "region_encoded")
    fixed = features.category_code(coded, "region", "fixed_code", [*lookups.REGION_STATES, lookups.OTHER_REGION])
    return fixed.select("id", "region", "region_encoded", "fixed_code")


REGION_CODE = with_ctes(
    f"""
SELECT id, region, CAST(dense_rank() OVER (ORDER BY region) - 1 AS INT) AS region_encoded,
       CAST(CASE region WHEN 'Midwest' THEN 0 WHEN 'Northeast' THEN 1 WHEN 'Other' THEN 2
                        WHEN 'South' THEN 3 ELSE 4 END AS INT) AS fixed_code
FROM (SELECT id, {REGION_CASE} AS region FROM decl)""",
    DECLARATIONS_SQL,
)


def severity_score(spark, folder):
    landed = durable(declarations(spark, folder))
    exposed = features.attach_climate(
        landed.select("id", "disasternumber", "incidenttype"), climate(spark, folder, landed), "disasternumber"
    )
    scored = features.blend_severity(
        exposed, lookups.type_severity(F.col("incidenttype")), features.CLIMATE_COLUMNS
    )
    return scored.select("id", F.round("incident_severity_score", 6).alias("incident_severity_score"))


FILLED_SQL = """
filled AS (
  SELECT decl.*, coalesce(wind_speed, 0.0) AS wind_speed, coalesce(flood_severity, 0) AS flood_severity,
         storm_event_count, coalesce(rainfall_intensity, 0.0) AS rainfall_intensity
  FROM decl LEFT JOIN climate ON decl.disasternumber = climate.disasternumber
),
bounds AS (
  SELECT min(wind_speed) AS wl, max(wind_speed) AS wh, min(flood_severity) AS fl, max(flood_severity) AS fh,
         min(rainfall_intensity) AS rl, max(rainfall_intensity) AS rh FROM filled
)"""
SCORE_SQL = f"""0.6 * ({SEVERITY_CASE}) + 0.4 * ((rainfall_intensity - rl) / (rh - rl + 1e-9)
     + (wind_speed - wl) / (wh - wl + 1e-9) + (flood_severity - fl) / (fh - fl + 1e-9)) / 3"""
SEVERITY_SCORE = with_ctes(
    f" SELECT id, round({SCORE_SQL}, 6) AS incident_severity_score FROM filled, bounds",
    *CLIMATE_CTES,
    FILLED_SQL,
)


def one_hot(spark, folder):
    rows = declarations(spark, folder).select("id", "incidenttype")
    labels = [row[0] for row in features.top_labels(rows, "incidenttype", features.TOP_TYPES).collect()]
    coded = features.one_hot(rows, "incidenttype", labels)
    flags = [c for c in coded.columns if c.startswith("is_")]
    # In long form, since which labels are frequent depends on the data.
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).alias("on")) for c in flags]))
    return coded.select("id", pairs.alias("p")).select("id", "p.flag", "p.on")


ONE_HOT = with_ctes(
    """,
top AS (SELECT incidenttype AS label FROM decl GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)
SELECT id, 'is_' || lower(replace(replace(label, ' ', '_'), '/', '_')) AS flag,
       CAST(incidenttype = label AS INT) AS "on"
FROM decl, top""",
    DECLARATIONS_SQL,
)


def discrepancy(spark, folder):
    cost = costs.cost_by_disaster(cleaning.clean_projects(projects(spark, folder)))
    joined = cost.join(cleaning.clean_summaries(summaries(spark, folder)), "disasternumber", "left")
    gaps = features.with_discrepancy(joined, "total_obligated_amount", "summary_total_obligations")
    return gaps.select(
        "disasternumber",
        F.round("obligation_discrepancy", 6).alias("obligation_discrepancy"),
        "high_discrepancy_flag",
    )


COST_SQL = """
cost AS (
  SELECT disasternumber, sum(amount) AS total, count(amount) AS n, avg(amount) AS mean, max(amount) AS top,
         sum(CASE WHEN category = 'A' THEN amount ELSE 0 END) AS cat_a,
         sum(CASE WHEN category = 'N' THEN amount ELSE 0 END) AS cat_n,
         sum(CASE WHEN category = 'R' THEN amount ELSE 0 END) AS cat_r,
         sum(CASE WHEN category NOT IN ('A', 'N', 'R') THEN amount ELSE 0 END) AS cat_other
  FROM projects GROUP BY disasternumber
)"""
DISCREPANCY = with_ctes(
    """
SELECT cost.disasternumber AS disasternumber, round(abs(total - reported) / nullif(reported, 0), 6) AS obligation_discrepancy,
       CAST(coalesce(abs(total - reported) / nullif(reported, 0) > 0.2, FALSE) AS INT) AS high_discrepancy_flag
FROM cost LEFT JOIN summaries ON cost.disasternumber = summaries.disasternumber""",
    PROJECTS_SQL,
    SUMMARIES_SQL,
    COST_SQL,
)


def high_cost(spark, folder):
    """Customers whose orders add up to more than the limit."""
    per_customer = table(spark, folder, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    everyone = table(spark, folder, "customer").select("c_custkey")
    joined = everyone.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return features.high_cost_flag(joined, "total", 2_500_000).select("c_custkey", "high_cost_disaster")


HIGH_COST = """
SELECT c_custkey, CAST(coalesce(sum(o_totalprice) > 2500000, FALSE) AS INT) AS high_cost_disaster
FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1"""

SIX = (
    "incident_duration_days days_to_declaration declaration_month_sin declaration_month_cos declaration_quarter_sin "
    "declaration_quarter_cos incident_severity_score severity_x_duration severity_x_frequency "
    "duration_x_days_to_declaration avg_project_cost obligation_discrepancy log_total_obligated_amount"
).split()
TWO = "total_obligated_amount cat_cost_A cat_cost_N cat_cost_R cat_cost_other".split()
WHOLE = (
    "disasternumber state incidenttype declarationtype declaration_year declaration_month declaration_quarter region "
    "state_disaster_frequency rainfall_intensity wind_speed flood_severity storm_event_count project_count max_project_cost "
    "summary_total_obligations high_discrepancy_flag region_encoded"
).split()
# The flags of the most frequent types, named by rank: which types they are depends on the data.
RANKS = range(1, features.TOP_TYPES + 1)


def feature_table(spark, folder):
    """The whole job: clean, match, count, blend, encode, cost, cross-check."""
    landed = durable(declarations(spark, folder))
    usable = cleaning.clean_projects(projects(spark, folder))
    names = costs.category_names(usable, "damagecategorycode")
    cost = costs.cost_by_disaster(usable, category="damagecategorycode", categories=names, rest="cat_cost_other")
    built = plan.engineer(
        cleaning.clean_declarations(landed.drop("applicant", "place")),
        cost,
        cleaning.clean_summaries(summaries(spark, folder)),
        climate(spark, folder, landed),
    )
    flags = dict(enumerate((c for c in built.columns if c.startswith("is_")), 1))
    return built.select(
        *WHOLE,
        *[F.round(c, 6).alias(c) for c in SIX],
        *[F.round(c, 2).alias(c) for c in TWO],
        *[(F.col(flags[k]) if k in flags else F.lit(0)).alias(f"is_type_{k}") for k in RANKS],
    )


SCORED_SQL = f"""
kept AS (
  SELECT filled.*, row_number() OVER (PARTITION BY state ORDER BY declarationdate, disasternumber) - 1 AS before,
         CASE WHEN incidentenddate IS NULL THEN 0.0 ELSE {DURATION_SQL.format('incidentbegindate', 'incidentenddate')} END AS lasted,
         {DURATION_SQL.format('incidentbegindate', 'declarationdate')} AS lag_days,
         {REGION_CASE} AS region
  FROM filled
),
scored AS (
  SELECT kept.*, {SCORE_SQL} AS score, year(declarationdate) AS y, month(declarationdate) AS m, quarter(declarationdate) AS q
  FROM kept, bounds
)"""
FREQUENT_SQL = """
frequent AS (
  SELECT incidenttype AS label, row_number() OVER (ORDER BY count(*) DESC, incidenttype) AS k
  FROM filled WHERE incidenttype IS NOT NULL GROUP BY 1
)"""
FLAG_SQL = ",\n       ".join(
    f"CAST(coalesce(incidenttype = (SELECT label FROM frequent WHERE k = {k}), FALSE) AS INT) AS is_type_{k}" for k in RANKS
)
# The exposures are matched for all declarations; only accepted types enter the table.
FEATURE_TABLE = with_ctes(
    f"""
SELECT scored.disasternumber AS disasternumber, state, incidenttype, declarationtype, CAST(y AS INT) AS declaration_year,
       CAST(m AS INT) AS declaration_month, CAST(q AS INT) AS declaration_quarter, region,
       before AS state_disaster_frequency, rainfall_intensity, wind_speed, flood_severity, storm_event_count,
       cost.n AS project_count, cost.top AS max_project_cost, reported AS summary_total_obligations,
       CAST(coalesce(abs(total - reported) / nullif(reported, 0) > 0.2, FALSE) AS INT) AS high_discrepancy_flag,
       CAST(dense_rank() OVER (ORDER BY region) - 1 AS INT) AS region_encoded,
       round(lasted, 6) AS incident_duration_days, round(lag_days, 6) AS days_to_declaration,
       round(sin(m * 2 * pi() / 12), 6) AS declaration_month_sin, round(cos(m * 2 * pi() / 12), 6) AS declaration_month_cos,
       round(sin(q * 2 * pi() / 4), 6) AS declaration_quarter_sin, round(cos(q * 2 * pi() / 4), 6) AS declaration_quarter_cos,
       round(score, 6) AS incident_severity_score, round(score * lasted, 6) AS severity_x_duration,
       round(score * before, 6) AS severity_x_frequency, round(lasted * lag_days, 6) AS duration_x_days_to_declaration,
       round(mean, 6) AS avg_project_cost,
       round(abs(total - reported) / nullif(reported, 0), 6) AS obligation_discrepancy,
       round(ln(1 + total), 6) AS log_total_obligated_amount,
       round(total, 2) AS total_obligated_amount, round(cat_a, 2) AS "cat_cost_A", round(cat_n, 2) AS "cat_cost_N",
       round(cat_r, 2) AS "cat_cost_R", round(cat_other, 2) AS cat_cost_other,
       {FLAG_SQL}
FROM scored JOIN cost ON scored.disasternumber = cost.disasternumber
     LEFT JOIN summaries ON scored.disasternumber = summaries.disasternumber""",
    *CLIMATE_CTES,
    FILLED_SQL.replace("FROM decl LEFT JOIN climate ON decl.disasternumber = climate.disasternumber",
                       "FROM decl LEFT JOIN climate ON decl.disasternumber = climate.disasternumber "
                       "WHERE declarationtype IN ('DR', 'EM', 'FM')"),
    SCORED_SQL,
    FREQUENT_SQL,
    PROJECTS_SQL,
    SUMMARIES_SQL,
    COST_SQL,
)

QUERIES = {
    "state_frequency": (state_frequency, STATE_FREQUENCY),
    "region_code": (region_code, REGION_CODE),
    "severity_score": (severity_score, SEVERITY_SCORE),
    "one_hot": (one_hot, ONE_HOT),
    "discrepancy": (discrepancy, DISCREPANCY),
    "high_cost": (high_cost, HIGH_COST),
    "feature_table": (feature_table, FEATURE_TABLE),
}
