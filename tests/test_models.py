"""Training, evaluation, importance and scoring on a small learnable table."""

import pytest
from pyspark.sql import functions as F

from aftermath.model_inputs import EARLY_FEATURES, STANDARD_FEATURES, TARGET, TYPE_FLAGS
from aftermath.operators import metrics, scoring
from aftermath.plans import importance, training
from aftermath.plans import scoring as scoring_plan

SMALL_FOREST = {"numTrees": [5, 8], "maxDepth": [3, 4]}
SMALL_BOOST = {"maxIter": [2, 3], "maxDepth": [1, 2]}
TINY = {"maxIter": 2, "maxDepth": 2, "stepSize": 0.7}


@pytest.fixture(scope="module")
def table(spark):
    """Cost driven by severity, weakly by duration, not at all by the month."""
    base = spark.range(400).select(
        F.col("id").alias("key"),
        (F.abs(F.hash("id")) % 100 / 100).alias("incident_severity_score"),
        (F.abs(F.hash("id", F.lit(1))) % 60).cast("double").alias("incident_duration_days"),
        (F.abs(F.hash("id", F.lit(2))) % 30).cast("double").alias("days_to_declaration"),
        (F.col("id") % 40).alias("state_disaster_frequency"),
        (F.col("id") % 5).cast("int").alias("region_encoded"),
        (2000 + F.col("id") % 27).cast("int").alias("declaration_year"),
        (F.abs(F.hash("id", F.lit(3))) % 12 + 1).cast("int").alias("declaration_month"),
        F.when(F.col("id") % 6 == 0, "Biological").when(F.col("id") % 7 != 0, "Fire").alias("incidenttype"),
        *[(F.col("id") % (i + 2) == 0).cast("int").alias(flag) for i, flag in enumerate(TYPE_FLAGS)],
    ).withColumn("declaration_quarter", F.ceil(F.col("declaration_month") / 3).cast("int"))
    rows = scoring.derive_inputs(base)
    cost = 5 + 8 * F.col("incident_severity_score") + 0.02 * F.col("incident_duration_days")
    return rows.withColumn(TARGET, F.when(F.col("key") != 7, cost)).cache()


@pytest.fixture(scope="module")
def trained(table):
    spaces = {"Random Forest": SMALL_FOREST, "Boosted Trees": SMALL_BOOST}
    return training.develop(table, "key", scoring.STANDARD, searches=2, folds=2, spaces=spaces)


def test_develop_trains_three_and_picks_the_best(spark, trained, tmp_path):
    assert set(trained) == {"Linear Regression", "Random Forest", "Boosted Trees"}
    assert trained["Linear Regression"].scores["r2"] > 0.99
    assert training.best(trained).scores["r2"] == max(t.scores["r2"] for t in trained.values())
    runs = training.registry_rows(spark, trained, scoring.STANDARD)
    training.record_runs(runs, str(tmp_path / "runs"))
    stored = spark.read.parquet(str(tmp_path / "runs"))
    assert stored.count() == 3 and metrics.best_run(stored, "model", "r2").head().model == training.best(trained).name


def test_search_settings_are_repeatable_and_distinct():
    first = training.draw(training.BOOST_SPACE, 50)
    assert first == training.draw(training.BOOST_SPACE, 50) and len(first) == 50
    assert len(training.draw(SMALL_BOOST, 50)) == 4


def test_early_version_never_sees_duration(table):
    features, missing = training.usable_features(table, scoring.EARLY)
    assert features == list(EARLY_FEATURES) and not missing
    with pytest.raises(ValueError, match="duration-dependent"):
        training.refuse_duration(STANDARD_FEATURES)
    assert training.usable_features(table.drop("is_fire"), scoring.EARLY)[1] == ["is_fire"]


def test_temporal_and_regime_evaluation(table):
    report = training.temporal_evaluation(table, scoring.EARLY, params=TINY)
    assert report["periods"]["train"]["last_year"] == 2022 and report["periods"]["test"]["first_year"] == 2023
    assert report["r2"] > 0.5
    regimes = {r.regime: r for r in training.regime_evaluation(table, "key", params=TINY).collect()}
    whole, part = regimes["All Disasters"], regimes["Non-Biological Disasters"]
    assert whole.samples == 399 and part.samples == 399 - 67 and part.train + part.test == part.samples


def test_importance(table, trained):
    model = trained["Boosted Trees"].model
    gain = importance.gain_importance(model, STANDARD_FEATURES).collect()
    assert gain[0].feature == "incident_severity_score" or gain[0]["rank"] == 1
    assert sum(r.importance_pct for r in gain) == pytest.approx(100, abs=1)
    test = metrics.hash_split(table.dropna(subset=[TARGET]), "key").where("split = 'test'")
    linear = trained["Linear Regression"].model
    got = importance.permutation_importance(linear, test, STANDARD_FEATURES, TARGET, "key", repeats=4).collect()
    assert len(got) == 23 and got[0].feature == "incident_severity_score" and got[0].importance_mean > 0.5
    assert {r.feature: r for r in got}["declaration_month_sin"].importance_mean == pytest.approx(0, abs=0.01)


def test_shuffles_are_one_to_one():
    for rows in (1, 2, 12, 97):
        for _, a, b in importance._shuffles(rows, 6, 1):
            assert sorted((i * a + b) % rows for i in range(rows)) == list(range(rows))


def request(**changes):
    fields = {
        "region_encoded": "4", "days_to_declaration": "7", "state_disaster_frequency": "12", "incident_severity_score": "0.62",
        "declaration_year": "2024", "declaration_month": "9", "declaration_quarter": "3", "is_hurricane": "1", "is_flood": "1",
    }
    fields.update(changes)
    return {k: v for k, v in fields.items() if v is not None}


CASES = [
    (request(), None, "B", []),
    (request(), " b ", "B", []),
    (request(incident_duration_days="14"), "a", "A", []),
    (request(), "A", "A", ["missing incident_duration_days"]),
    (request(incident_duration_days="14"), "B", "B", ["duration not accepted"]),
    (request(severity_x_duration="1"), "B", "B", ["duration not accepted"]),
    (request(incident_duration_days="14", severity_x_duration="1"), "A", "A", ["unknown field"]),
    (request(), "C", "C", ["invalid version"]),
    (request(mood="calm"), "B", "B", ["unknown field"]),
    (request(region_encoded="9"), "B", "B", ["invalid region_encoded"]),
    (request(region_encoded="1.5"), "B", "B", ["invalid region_encoded"]),
    (request(incident_severity_score="1.01"), "B", "B", ["invalid incident_severity_score"]),
    (request(declaration_year="1949"), "B", "B", ["invalid declaration_year"]),
    (request(is_fire="2"), "B", "B", ["invalid is_fire"]),
    (request(days_to_declaration=None), "B", "B", ["missing days_to_declaration"]),
    (request(days_to_declaration="soon"), "B", "B", ["invalid days_to_declaration"]),
    (request(incident_duration_days="-1"), "A", "A", ["invalid incident_duration_days"]),
]


@pytest.fixture(scope="module")
def requests(spark):
    return spark.createDataFrame([(i, f, v) for i, (f, v, _, _) in enumerate(CASES)], "n int, fields map<string,string>, version string")


def test_scenario_rules(requests):
    got = {r.n: (r.model, r.errors) for r in scoring.validate_scenarios(requests).collect()}
    for n, (_, _, model, errors) in enumerate(CASES):
        assert got[n] == (model, errors), CASES[n]


def test_default_version_can_be_set(requests):
    judged = scoring.validate_scenarios(requests.where("n = 0"), default=" a ").head()
    assert judged.model == "A" and judged.errors == ["missing incident_duration_days"]


def test_batch_scoring_with_both_models(requests, table, trained):
    early = training.pipeline(EARLY_FEATURES, training.boosted(TINY)).fit(table.dropna(subset=[TARGET]))
    models = {scoring.STANDARD: trained["Linear Regression"].model, scoring.EARLY: early}
    answers, refused = scoring_plan.score_requests(requests, models)
    got = {r.n: r for r in answers.collect()}
    assert set(got) == {0, 1, 2} and refused.count() == len(CASES) - 3
    assert got[2].model_type == "Model A — Standard Forecast" and got[0].forecast_mode == "early_forecast"
    assert got[2].log_prediction == pytest.approx(5 + 8 * 0.62 + 0.02 * 14, abs=0.05)
    gaps = scoring.budget_gaps(answers.where("n = 2"), "predicted_recovery_cost_usd").collect()
    assert [r.budget_allocation for r in gaps] == ["50%", "70%", "90%", "100%", "110%", "130%"]
    assert gaps[0].gap_usd == pytest.approx(-got[2].predicted_recovery_cost_usd / 2)


def test_suggested_severity_and_fields(spark):
    rows = spark.createDataFrame([(["Hurricane", "Flood"], 9), ([], 1), (["Meteor", "Fire"], 12), (None, 3)], "kinds array<string>, month int")
    got = scoring.suggested_severity(rows, "kinds").withColumns(scoring.scenario_fields(F.col("month"), F.col("kinds"))).collect()
    assert [r.suggested_severity for r in got] == [0.875, 0.0, 0.25, 0.0]
    assert [r.declaration_quarter for r in got] == [3, 1, 4, 1] and got[0].is_hurricane == 1 and got[0].is_fire == 0


def test_metrics_and_splits(spark):
    rows = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0), (None, 1.0)], "y double, p double")
    row = metrics.regression_metrics(rows, "y", "p").head()
    assert (row.n, row.mae) == (3, 0.5) and row.r2 == pytest.approx(1 - 1.25 / (14 / 3), abs=1e-4)
    flat = metrics.regression_metrics(spark.createDataFrame([(1.0, 1.0)], "y double, p double"), "y", "p").head()
    assert flat.r2 is None
    dollars = metrics.dollar_metrics(rows, "y", "p").head()
    assert dollars.actual_median == pytest.approx(2.718281828**2 - 1)
    split = metrics.hash_split(spark.range(2000), "id")
    again = metrics.hash_split(spark.range(2000).repartition(7), "id")
    assert split.where("split = 'test'").count() == again.where("split = 'test'").count()
    assert 300 < split.where("split = 'test'").count() < 500
