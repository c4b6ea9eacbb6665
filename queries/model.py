"""Splits, metrics, reports and scenarios.

Predictions and scores use fixed formulas, so that the comparison engine can
repeat them; fitted models are covered by the tests.
"""

from pyspark.sql import functions as F

from aftermath.operators import cleaning, metrics, scoring
from aftermath.plans import boosting
from aftermath.session import durable
from queries.bindings import DECLARATIONS_SQL, KINDS, declarations, pick, table, with_ctes


def hash_split(spark, folder):
    return metrics.hash_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


SPLIT_SQL = (
    "CASE WHEN CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT) % 100 < 20 THEN 'test' ELSE 'train' END"
)
HASH_SPLIT = f"SELECT o_orderkey, {SPLIT_SQL} AS split FROM orders"


def temporal_split(spark, folder):
    dated = table(spark, folder, "orders").select(F.year("o_orderdate").cast("int").alias("year"))
    return metrics.split_report(metrics.year_split(dated, "year", 1999), "year")


TEMPORAL_SPLIT = """
SELECT CASE WHEN year(o_orderdate) <= 1999 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       CAST(min(year(o_orderdate)) AS INT) AS first_year, CAST(max(year(o_orderdate)) AS INT) AS last_year
FROM orders GROUP BY 1"""


def predictions(spark, folder):
    """Orders with log price and a prediction that knows the month and the priority only."""
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_orderstatus",
        F.log1p(price).alias("label"),
        (F.log1p(price) * 0.7 + F.month("o_orderdate") * 0.1 + F.col("o_orderkey") % 11 * 0.3 + 2.0).alias("prediction"),
    )


PREDICTIONS_SQL = """
predictions AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, ln(1 + o_totalprice) AS label,
         ln(1 + o_totalprice) * 0.7 + month(o_orderdate) * 0.1 + o_orderkey % 11 * 0.3 + 2.0 AS prediction
  FROM orders
)"""
MEASURES_SQL = """count(*) AS n,
       round(1 - sum((label - prediction) * (label - prediction)) / (var_pop(label) * count(*)), 4) AS r2,
       round(sqrt(avg((label - prediction) * (label - prediction))), 4) AS rmse,
       round(avg(abs(label - prediction)), 4) AS mae"""


def reg_metrics(spark, folder):
    return metrics.regression_metrics(predictions(spark, folder), "label", "prediction", ["o_orderpriority"])


REG_METRICS = with_ctes(
    f" SELECT o_orderpriority, {MEASURES_SQL} FROM predictions GROUP BY o_orderpriority", PREDICTIONS_SQL
)


def dollar_metrics(spark, folder):
    measured = metrics.dollar_metrics(predictions(spark, folder), "label", "prediction")
    return measured.select("n", *[F.round(c, 2).alias(c) for c in measured.columns if c != "n"])


DOLLAR_METRICS = with_ctes(
    """
SELECT count(*) AS n, round(avg(abs(a - p)), 2) AS mae, round(sqrt(avg((a - p) * (a - p))), 2) AS rmse,
       round(avg(a), 2) AS actual_mean, round(avg(p), 2) AS predicted_mean,
       round(quantile_cont(a, 0.5), 2) AS actual_median, round(quantile_cont(p, 0.5), 2) AS predicted_median
FROM (SELECT exp(label) - 1 AS a, exp(prediction) - 1 AS p FROM predictions)""",
    PREDICTIONS_SQL,
)


def regime_compare(spark, folder):
    """Metrics on the test rows of all declarations and of those that are not biological."""
    kinds = declarations(spark, folder).select(F.col("id").alias("o_orderkey"), "incidenttype")
    rows = cleaning.complete_cases(
        predictions(spark, folder).join(kinds, "o_orderkey"), ["label", "prediction"]
    )
    rows = metrics.hash_split(rows, "o_orderkey")
    regimes = F.explode(
        F.array_compact(
            F.array(
                F.lit("All Disasters"),
                F.when(~F.col("incidenttype").eqNullSafe("Biological"), F.lit("Non-Biological Disasters")),
            )
        )
    )
    tagged = rows.withColumn("regime", regimes)
    return metrics.regression_metrics(tagged, "label", "prediction", ["regime", "split"])


REGIME_COMPARE = with_ctes(
    f""",
tagged AS (
  SELECT predictions.*, incidenttype, {SPLIT_SQL} AS split FROM predictions JOIN decl ON predictions.o_orderkey = decl.id
)
SELECT 'All Disasters' AS regime, split, {MEASURES_SQL} FROM tagged GROUP BY split
UNION ALL
SELECT 'Non-Biological Disasters' AS regime, split, {MEASURES_SQL} FROM tagged
WHERE incidenttype IS DISTINCT FROM 'Biological' GROUP BY split""",
    DECLARATIONS_SQL,
    PREDICTIONS_SQL,
)


def importance_rank(spark, folder):
    """Part types ranked by their share of revenue."""
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_extendedprice")
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_type").alias("feature"))
    weights = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("feature")
        .agg(F.round(F.sum("l_extendedprice"), 2).alias("importance"))
    )
    return metrics.importance_table(weights)


IMPORTANCE_RANK = """
SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank,
       round(importance / sum(importance) OVER () * 100, 2) AS importance_pct
FROM (SELECT p_type AS feature, round(sum(l_extendedprice), 2) AS importance
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)"""


def best_model(spark, folder):
    """Per order status the priority whose prediction has the highest R2."""
    runs = metrics.regression_metrics(
        predictions(spark, folder), "label", "prediction", ["o_orderstatus", "o_orderpriority"]
    )
    return metrics.best_run(runs, "o_orderpriority", "r2", ["o_orderstatus"])


BEST_MODEL = with_ctes(
    f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY r2 DESC, o_orderpriority) AS rn
  FROM (SELECT o_orderstatus, o_orderpriority, {MEASURES_SQL} FROM predictions GROUP BY 1, 2))
WHERE rn = 1""",
    PREDICTIONS_SQL,
)


def scenario_map(entries: dict):
    """A map column from field to text; a null text means the field was not sent."""
    pairs = F.array(*[F.struct(F.lit(name), value.cast("string")) for name, value in entries.items()])
    return F.map_filter(F.map_from_entries(pairs), lambda name, value: value.isNotNull())


def requests(spark, folder):
    """One landed request per customer, many with a defect."""
    k = F.col("c_custkey")
    fields = scenario_map(
        {
            "region_encoded": k % 6,
            "incident_duration_days": F.when(k % 5 != 0, k % 30),
            "days_to_declaration": F.when(k % 17 == 0, "soon").otherwise((k % 60).cast("string")),
            "state_disaster_frequency": F.when(k % 19 != 0, k % 100),
            "incident_severity_score": (k % 101) / 80.0,
            "declaration_year": 1940 + k % 90,
            "declaration_month": k % 14,
            "declaration_quarter": 1 + k % 4,
            "is_hurricane": k % 3,
            "is_flood": F.when(k % 2 == 0, F.lit(1)),
            "mood": F.when(k % 23 == 0, "calm"),
        }
    )
    version = pick([None, "A", " b ", "C", "", "a ", "B"], k % 7)
    return durable(table(spark, folder, "customer").select("c_custkey", fields.alias("fields"), version.alias("version")))


def scenario_validate(spark, folder):
    judged = scoring.validate_scenarios(requests(spark, folder))
    return judged.select("c_custkey", "model", F.array_join(F.array_sort("errors"), "; ").alias("errors"))


SCENARIO_VALIDATE = """
SELECT c_custkey, model, concat_ws('; ',
         CASE WHEN model = 'B' AND k % 5 <> 0 THEN 'duration not accepted' END,
         CASE WHEN k % 17 = 0 THEN 'invalid days_to_declaration' END,
         CASE WHEN k % 14 IN (0, 13) THEN 'invalid declaration_month' END,
         CASE WHEN k % 90 < 10 THEN 'invalid declaration_year' END,
         CASE WHEN k % 101 > 80 THEN 'invalid incident_severity_score' END,
         CASE WHEN k % 3 = 2 THEN 'invalid is_hurricane' END,
         CASE WHEN k % 6 = 5 THEN 'invalid region_encoded' END,
         CASE WHEN model = 'C' THEN 'invalid version' END,
         CASE WHEN model = 'A' AND k % 5 = 0 THEN 'missing incident_duration_days' END,
         CASE WHEN k % 19 = 0 THEN 'missing state_disaster_frequency' END,
         CASE WHEN k % 23 = 0 THEN 'unknown field' END) AS errors
FROM (SELECT c_custkey, c_custkey AS k,
             CASE c_custkey % 7 WHEN 1 THEN 'A' WHEN 5 THEN 'A' WHEN 3 THEN 'C' ELSE 'B' END AS model FROM customer)"""

COEFFICIENTS = {
    "region_encoded": 0.05,
    "days_to_declaration": 0.01,
    "state_disaster_frequency": 0.002,
    "incident_severity_score": 3.0,
    "declaration_month_sin": 0.2,
    "declaration_month_cos": -0.1,
    "declaration_quarter_sin": 0.3,
    "declaration_quarter_cos": 0.15,
    "severity_x_frequency": 0.01,
    "is_hurricane": 0.8,
    "is_flood": 0.4,
}
DURATION_COEFFICIENTS = {
    "incident_duration_days": 0.02,
    "severity_x_duration": 0.015,
    "duration_x_days_to_declaration": -0.0004,
}
INTERCEPT = 9.0000123


def sound_requests(spark, folder):
    """One acceptable request per customer: chosen types, month, and a duration if model A is asked for."""
    k = F.col("c_custkey")
    month = k % 12 + 1
    kinds = F.array_compact(F.array(F.when(k % 3 == 0, F.lit("Hurricane")), F.when(k % 2 == 0, F.lit("Flood"))))
    derived = scoring.scenario_fields(month, kinds)
    fields = scenario_map(
        {
            "region_encoded": k % 5,
            "incident_duration_days": F.when(k % 4 == 1, k % 30),
            "days_to_declaration": k % 60,
            "state_disaster_frequency": k % 100,
            "incident_severity_score": (k % 101) / 100.0,
            "declaration_year": 1960 + k % 60,
            "declaration_month": month,
            **derived,
        }
    )
    version = F.when(k % 4 == 1, "A")
    return durable(table(spark, folder, "customer").select("c_custkey", fields.alias("fields"), version.alias("version")))


def scored(spark, folder):
    inputs = scoring.derive_inputs(
        scoring.open_scenarios(scoring.validate_scenarios(sound_requests(spark, folder)))
    )
    early = scoring.linear_prediction(COEFFICIENTS, INTERCEPT)
    standard = scoring.linear_prediction({**COEFFICIENTS, **DURATION_COEFFICIENTS}, INTERCEPT)
    logs = inputs.withColumn("log", F.when(F.col("model") == scoring.STANDARD, standard).otherwise(early))
    return scoring.forecast(logs, "log")


def score_scenarios(spark, folder):
    return scored(spark, folder).select(
        "c_custkey", "model_type", "forecast_type", "forecast_mode", "log_prediction", "predicted_recovery_cost_usd"
    )


LINEAR_SQL = """
inputs AS (
  SELECT c_custkey, c_custkey % 4 = 1 AS a, c_custkey % 5 AS region, c_custkey % 60 AS lag, c_custkey % 100 AS freq,
         (c_custkey % 101) / 100.0 AS sev, c_custkey % 12 + 1 AS m, c_custkey % 12 // 3 + 1 AS q, c_custkey % 30 AS dur,
         CAST(c_custkey % 3 = 0 AS INT) AS hur, CAST(c_custkey % 2 = 0 AS INT) AS flo
  FROM customer
),
logs AS (
  SELECT *, 9.0000123::DOUBLE + region * 0.05 + lag * 0.01 + freq * 0.002 + sev * 3.0 + sin(m * 2 * pi() / 12) * 0.2
         - cos(m * 2 * pi() / 12) * 0.1 + sin(q * 2 * pi() / 4) * 0.3 + cos(q * 2 * pi() / 4) * 0.15 + sev * freq * 0.01
         + hur * 0.8 + flo * 0.4
         + CASE WHEN a THEN dur * 0.02 + sev * dur * 0.015 - dur * lag * 0.0004 ELSE 0 END AS log
  FROM inputs
)"""
SCORE_SCENARIOS = with_ctes(
    """
SELECT c_custkey, CASE WHEN a THEN 'Model A — Standard Forecast' ELSE 'Model B — Early Forecast' END AS model_type,
       CASE WHEN a THEN 'Standard Forecast' ELSE 'Early Forecast' END AS forecast_type,
       CASE WHEN a THEN 'scenario' ELSE 'early_forecast' END AS forecast_mode,
       round(log, 4) AS log_prediction, round(exp(log) - 1, 2) AS predicted_recovery_cost_usd
FROM logs""",
    LINEAR_SQL,
)


def budget_gap(spark, folder):
    gaps = scoring.budget_gaps(scored(spark, folder), "predicted_recovery_cost_usd")
    return gaps.select("c_custkey", "budget_allocation", F.round("gap_usd", 3).alias("gap_usd"))


BUDGET_GAP = with_ctes(
    """
SELECT c_custkey, label AS budget_allocation,
       round(round(exp(log) - 1, 2) * level - round(exp(log) - 1, 2), 3) AS gap_usd
FROM logs CROSS JOIN (VALUES ('50%', 0.5::DOUBLE), ('70%', 0.7::DOUBLE), ('90%', 0.9::DOUBLE), ('100%', 1.0::DOUBLE),
                             ('110%', 1.1::DOUBLE), ('130%', 1.3::DOUBLE)) AS levels(label, level)""",
    LINEAR_SQL,
)


def severity_baseline(spark, folder):
    """Orders of a customer name the types chosen; orders without a known type count as 0."""
    k = F.col("o_orderkey")
    chosen = F.array_compact(
        F.array(
            pick(KINDS, k % 13),
            F.when(k % 2 == 0, pick(KINDS, (k + 5) % 13)),
            F.when(k % 3 == 0, pick(KINDS, (k + 9) % 13)),
        )
    )
    rows = table(spark, folder, "orders").select("o_orderkey", F.when(k % 8 == 0, F.array().cast("array<string>")).otherwise(chosen).alias("kinds"))
    scored_rows = scoring.suggested_severity(rows, "kinds")
    return scored_rows.select("o_orderkey", F.round("suggested_severity", 6).alias("suggested_severity"))


BASE_VALUES = [1.0, 0.75, 0.75, 0.5, 0.5, 0.5, 0.25, 0.25, 0.75, 0.0, 1.0, 0.0, 0.0]
SEVERITY_BASELINE = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 0 THEN 0.0::DOUBLE ELSE round(
         (v[CAST(o_orderkey % 13 AS INT) + 1]
          + CASE WHEN o_orderkey % 2 = 0 THEN v[CAST((o_orderkey + 5) % 13 AS INT) + 1] ELSE 0 END
          + CASE WHEN o_orderkey % 3 = 0 THEN v[CAST((o_orderkey + 9) % 13 AS INT) + 1] ELSE 0 END)::DOUBLE
         / (1 + CAST(o_orderkey % 2 = 0 AS INT) + CAST(o_orderkey % 3 = 0 AS INT)), 6) END AS suggested_severity
FROM orders, (SELECT [{', '.join(f'{x}::DOUBLE' for x in BASE_VALUES)}] AS v)"""

# Every value of these columns is a cut.
SPLIT_FEATURES = ("l_quantity", "l_discount", "l_tax")
SPLIT_SETTINGS = boosting.Settings(l1=0.5, l2=1.5, min_child=20.0)


def _prices(spark, folder):
    """Lines with the gradient of their log price from its mean; bins number the values from the smallest."""
    lines = table(spark, folder, "lineitem")
    y = F.log1p("l_extendedprice")
    # the distinct values of three short decimal columns
    values = [sorted(r[0] for r in lines.select(c).distinct().collect() if r[0] is not None) for c in SPLIT_FEATURES]
    mean = lines.agg(F.avg(y)).head()[0]
    bins = F.array(*(boosting.binned(F.col(c), v) for c, v in zip(SPLIT_FEATURES, values)))
    rows = lines.select("l_linenumber", (F.lit(mean) - y).alias("gradient"), F.lit(1.0).alias("hessian"), bins.alias("bins"))
    names = [(f, c, b, float(v)) for f, (c, some) in enumerate(zip(SPLIT_FEATURES, values)) for b, v in enumerate(some)]
    return rows, F.broadcast(spark.createDataFrame(names, "feature int, name string, bin int, threshold double"))


def boost_split(spark, folder):
    """Every first split of a tree on the lines, with its gain and the steps of both sides."""
    rows, names = _prices(spark, folder)
    allowed = boosting.candidates(boosting.histograms(rows.withColumn("node", F.lit(0))), SPLIT_SETTINGS).join(names, ["feature", "bin"])
    step = lambda side: F.round(boosting.leaf_weight(F.col(f"{side}_g"), F.col(f"{side}_h"), SPLIT_SETTINGS), 8)
    return allowed.select(
        F.col("name").alias("feature"),
        "threshold",
        F.round("gain", 4).alias("gain"),
        "left_n",
        "right_n",
        step("left").alias("left_step"),
        step("right").alias("right_step"),
    )


SPLITS_SQL = """
rows AS (
  SELECT l_linenumber, avg(ln(1 + l_extendedprice)) OVER () - ln(1 + l_extendedprice) AS g,
         unnest([{'f': 'l_quantity', 'v': CAST(l_quantity AS DOUBLE)}, {'f': 'l_discount', 'v': CAST(l_discount AS DOUBLE)},
                 {'f': 'l_tax', 'v': CAST(l_tax AS DOUBLE)}]) AS x
  FROM lineitem
),
cuts AS (SELECT GROUP_BY x.f AS feature, x.v AS threshold, sum(g) AS g, count(*) AS n FROM rows GROUP BY ALL),
sides AS (
  SELECT GROUP_BY feature, threshold, sum(g) OVER upto AS lg, sum(n) OVER upto AS ln, sum(g) OVER whole AS ag, sum(n) OVER whole AS an
  FROM cuts
  WINDOW upto AS (PARTITION BY GROUP_BY feature ORDER BY threshold), whole AS (PARTITION BY GROUP_BY feature)
),
splits AS (
  SELECT *, ag - lg AS rg, an - ln AS rn, greatest(abs(lg) - 0.5, 0) ** 2 / (ln + 1.5)
         + greatest(abs(ag - lg) - 0.5, 0) ** 2 / (an - ln + 1.5) - greatest(abs(ag) - 0.5, 0) ** 2 / (an + 1.5) AS gain
  FROM sides WHERE ln >= 20 AND an - ln >= 20
)"""

BOOST_SPLIT = with_ctes(
    """
SELECT feature, threshold, round(gain, 4) AS gain, CAST(ln AS BIGINT) AS left_n, CAST(rn AS BIGINT) AS right_n,
       round(-0.1 * sign(lg) * greatest(abs(lg) - 0.5, 0) / (ln + 1.5), 8) AS left_step,
       round(-0.1 * sign(rg) * greatest(abs(rg) - 0.5, 0) / (rn + 1.5), 8) AS right_step
FROM splits""",
    SPLITS_SQL.replace("GROUP_BY ", ""),
)


def boost_gain(spark, folder):
    """The mean gain per split over the first splits of one tree for each line number."""
    rows, names = _prices(spark, folder)
    found = boosting.histograms(rows.withColumnRenamed("l_linenumber", "node"))
    chosen = boosting.best_splits(boosting.candidates(found, SPLIT_SETTINGS))
    ranked = boosting.gain_per_split(chosen, names.select("feature", "name").distinct())
    return ranked.select(
        "feature", F.round("importance", 4).alias("importance"), "splits", F.round("total_gain", 4).alias("total_gain"), "rank", "importance_pct"
    )


BOOST_GAIN = with_ctes(
    """,
best AS (
  SELECT * FROM splits QUALIFY row_number() OVER (
    PARTITION BY l_linenumber ORDER BY gain DESC, CASE feature WHEN 'l_quantity' THEN 0 WHEN 'l_discount' THEN 1 ELSE 2 END, threshold) = 1
),
means AS (SELECT feature, avg(gain) AS importance, count(*) AS splits, sum(gain) AS total_gain FROM best GROUP BY feature)
SELECT feature, round(importance, 4) AS importance, splits, round(total_gain, 4) AS total_gain,
       row_number() OVER (ORDER BY importance DESC, feature) AS rank, round(importance / sum(importance) OVER () * 100, 2) AS importance_pct
FROM means""",
    SPLITS_SQL.replace("GROUP_BY ", "l_linenumber, "),
)

QUERIES = {
    "hash_split": (hash_split, HASH_SPLIT),
    "temporal_split": (temporal_split, TEMPORAL_SPLIT),
    "reg_metrics": (reg_metrics, REG_METRICS),
    "dollar_metrics": (dollar_metrics, DOLLAR_METRICS),
    "regime_compare": (regime_compare, REGIME_COMPARE),
    "importance_rank": (importance_rank, IMPORTANCE_RANK),
    "best_model": (best_model, BEST_MODEL),
    "boost_split": (boost_split, BOOST_SPLIT),
    "boost_gain": (boost_gain, BOOST_GAIN),
    "scenario_validate": (scenario_validate, SCENARIO_VALIDATE),
    "score_scenarios": (score_scenarios, SCORE_SCENARIOS),
    "severity_baseline": (severity_baseline, SEVERITY_BASELINE),
    "budget_gap": (budget_gap, BUDGET_GAP),
}
