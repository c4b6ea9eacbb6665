"""Feature columns and the feature table job on hand-made rows."""

import math

import pytest
from pyspark.sql import functions as F

from aftermath.model_inputs import EARLY_FEATURES, STANDARD_FEATURES, TARGET
from aftermath.operators import explore, features
from aftermath.plans import features as plan
from aftermath.sources import store, tables


def test_blend_uses_table_bounds_or_given_bounds(spark):
    rows = spark.createDataFrame([(0.5, 0.0, 10.0), (1.0, 4.0, 20.0)], "sev double, wind_speed double, rainfall_intensity double")
    columns = ["rainfall_intensity", "wind_speed"]
    got = [r.incident_severity_score for r in features.blend_severity(rows, F.col("sev"), columns).orderBy("sev").collect()]
    assert got == pytest.approx([0.3, 1.0])
    train = features.scaling_bounds(rows.where("wind_speed = 0"), columns)
    later = features.blend_severity(rows.where("wind_speed = 0"), F.col("sev"), columns, train)
    assert later.head().incident_severity_score == pytest.approx(0.3)
    assert features.blend_severity(rows, F.col("sev"), []).orderBy("sev").head().incident_severity_score == 0.5


def test_ties_at_the_last_rank_go_by_name(spark):
    names = ["a"] * 3 + ["d", "c", "b"] + [None] * 9
    top = features.top_labels(spark.createDataFrame([(n,) for n in names], "t string"), "t", 2)
    assert [r.t for r in top.collect()] == ["a", "b"]


def test_one_hot_slugs_and_nulls(spark):
    rows = spark.createDataFrame([("Dam/Levee Break",), (None,)], "t string")
    got = features.one_hot(rows, "t", ["Dam/Levee Break", "Fire"])
    assert sorted((r["is_dam_levee_break"], r["is_fire"]) for r in got.collect()) == [(0, 0), (1, 0)]


def test_discrepancy_edges(spark):
    rows = spark.createDataFrame([(1, 130.0, 100.0), (2, 110.0, 100.0), (3, 5.0, 0.0), (4, 5.0, None)], "k int, a double, b double")
    got = {r.k: (r.obligation_discrepancy, r.high_discrepancy_flag) for r in features.with_discrepancy(rows, "a", "b").collect()}
    assert got[1] == (pytest.approx(0.3), 1) and got[2] == (pytest.approx(0.1), 0)
    assert got[3] == (None, 0) and got[4] == (None, 0)


def test_region_codes_shift_or_stay(spark):
    rows = spark.createDataFrame([("West",), ("Midwest",), (None,)], "region string")
    shifting = features.category_code(rows, "region", "code")
    assert {r.region: r.code for r in shifting.collect()} == {"Midwest": 0, "West": 1, None: -1}
    fixed = features.category_code(rows, "region", "code", ["Midwest", "Northeast", "Other", "South", "West"])
    assert {r.region: r.code for r in fixed.collect()} == {"Midwest": 0, "West": 4, None: -1}


def test_high_cost_and_group_size(spark):
    rows = spark.createDataFrame([(11e6, "a"), (10e6, "a"), (None, None)], "t double, s string")
    assert sorted(r.high_cost_disaster for r in features.high_cost_flag(rows, "t").collect()) == [0, 0, 1]
    assert [r.n for r in explore.group_size(rows, "s", "n").collect()] == [2, 2]


def raw(spark):
    decl = spark.createDataFrame(
        [
            ("a", 1, "TX", "Hurricane", "2020-01-10T00:00:00.000Z", "2020-01-05T00:00:00.000Z", "2020-01-15T12:00:00.000Z", "DR", "1"),
            ("b", 1, "TX", "Hurricane", "2020-01-11T00:00:00.000Z", "2020-01-05T00:00:00.000Z", None, "DR", "2"),
            ("c", 2, "TX", "Fire", "2020-06-10T00:00:00.000Z", "2020-06-12T00:00:00.000Z", None, "EM", "1"),
            ("d", 3, "PR", "Unknown Thing", "2021-06-10T00:00:00.000Z", None, None, "FM", "1"),
            ("e", 4, "TX", "Fire", "2021-07-10T00:00:00.000Z", None, None, "DR", "1"),
        ],
        "id string, disasterNumber long, state string, incidentType string, declarationDate string, incidentBeginDate string, incidentEndDate string, declarationType string, lastRefresh string",
    )
    projects = spark.createDataFrame([(1, 100.0, "A"), (1, 50.0, "B"), (2, 10.0, "A"), (3, 7.0, None)], "disasterNumber long, federalShareObligated double, damageCategoryCode string")
    summaries = spark.createDataFrame([(1, 100.0), (2, 0.0)], "disasterNumber long, totalObligatedAmountPa double")
    return decl, projects, summaries


def test_feature_table(spark):
    climate = spark.createDataFrame([(1, 50.0, 2, 3, 10.0), (2, None, None, None, 5.0)], "disasternumber long, wind_speed double, flood_severity long, storm_event_count long, rainfall_intensity double")
    table = plan.build(*raw(spark), climate)
    rows = {r.disasternumber: r for r in table.collect()}
    assert set(rows) == {1, 2, 3}  # disaster 4 has no cost
    one, two, three = rows[1], rows[2], rows[3]
    assert (one.state_disaster_frequency, two.state_disaster_frequency, three.state_disaster_frequency) == (0, 1, 0)
    assert one.incident_duration_days == 10.5 and one.days_to_declaration == 5.0
    assert two.days_to_declaration == 0.0 and two.incident_duration_days == 0.0
    assert one.incident_severity_score == pytest.approx(1.0, abs=1e-6)
    assert two.incident_severity_score == pytest.approx(0.6 * 0.5 + 0.4 * (0.5 / 3), abs=1e-6)
    assert three.incident_severity_score == 0.0 and three.storm_event_count is None and three.wind_speed == 0.0
    assert (one.region, three.region) == ("South", "Other") and (one.region_encoded, three.region_encoded) == (1, 0)
    assert one.total_obligated_amount == 150.0 and one.cat_cost_B == 50.0 and three.cat_cost_A == 0.0
    assert one.high_discrepancy_flag == 1 and two.obligation_discrepancy is None
    assert one[TARGET] == pytest.approx(math.log1p(150.0))
    assert one.is_hurricane == 1 and two.is_fire == 1 and three.is_unknown_thing == 1
    assert one.severity_x_duration == pytest.approx(one.incident_severity_score * 10.5)


def test_feature_table_without_climate(spark, tmp_path):
    climate = tables.load(spark, str(tmp_path / "absent"), tables.STORM_SCHEMA).join(
        tables.load(spark, str(tmp_path / "gone"), tables.RAIN_SCHEMA), "disasternumber", "full"
    )
    rows = plan.build(*raw(spark), climate).collect()
    assert {r.disasternumber for r in rows} == {1, 2, 3} and all(r.wind_speed == 0.0 for r in rows)


def test_feature_lists():
    assert len(STANDARD_FEATURES) == 23 and len(EARLY_FEATURES) == 20
    assert set(STANDARD_FEATURES) - set(EARLY_FEATURES) == {"incident_duration_days", "severity_x_duration", "duration_x_days_to_declaration"}


def test_publish_replaces_whole_tables(spark, tmp_path):
    root = str(tmp_path / "features")
    assert store.published(spark, root) is None
    store.publish(spark.range(3), root)
    store.publish(spark.range(5).withColumn("x", F.lit(1)), root)
    current = store.published(spark, root)
    assert current.count() == 5 and current.columns == ["id", "x"]


def test_run_snapshots_replace_their_date_only(spark, tmp_path):
    path = str(tmp_path / "runs")
    tables.write_run(spark.range(3), path, "2024-01-01")
    tables.write_run(spark.range(4), path, "2024-01-02")
    tables.write_run(spark.range(5), path, "2024-01-02")
    counts = {str(r.run_date): r["count"] for r in spark.read.parquet(path).groupBy("run_date").count().collect()}
    assert counts == {"2024-01-01": 3, "2024-01-02": 5}
    tables.export_csv(spark.range(2), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2


def test_quality_gate(spark):
    assert explore.quality_gate(None, ["id"]) == {"exists": False, "non_empty": False, "missing_columns": ["id"], "ok": False}
    assert explore.quality_gate(spark.range(1), ["id"])["ok"]
    assert not explore.quality_gate(spark.range(0), ["id"])["ok"]
    assert explore.null_counts(spark.createDataFrame([(1, None), (2, "x")], "a int, b string")).head().asDict() == {"a": 0, "b": 1}
