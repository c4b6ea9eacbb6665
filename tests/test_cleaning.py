"""Cleaning rules on rows with every known defect."""

import pytest
from pyspark.sql import functions as F

from aftermath.operators import cleaning, costs

DECL = "id string, ` disasterNumber` string, state string, declarationType string, `declarationDate ` string, lastRefresh string"


def test_declarations_keep_first_by_refresh_then_id(spark):
    rows = [
        ("b", "1", "TX", "DR", "2020-01-02T00:00:00.000Z", "2020-02-01"),
        ("a", "1.0", "TX", "DR", "2020-01-03T00:00:00.000Z", "2020-02-01"),
        ("c", "1", "TX", "DR", "2020-01-04T00:00:00.000Z", "2020-03-01"),
        ("d", "1", "OK", "FM", "2020-01-02T00:00:00.000Z", None),
        ("e", "2", "TX", "XX", "2020-01-02T00:00:00.000Z", "2020-01-01"),
        ("f", "3", "TX", "EM", "bad", "2020-01-01"),
        ("g", "x", "TX", "EM", "2020-01-02T00:00:00.000Z", "2020-01-01"),
        ("h", None, "TX", "EM", "2020-01-02T00:00:00.000Z", "2020-01-01"),
        ("i", "4", None, "EM", "2020-01-02T00:00:00.000Z", "2020-01-02"),
        ("j", "4", None, "EM", "2020-01-02T00:00:00.000Z", "2020-01-01"),
    ]
    clean = cleaning.clean_declarations(spark.createDataFrame(rows, DECL))
    assert sorted(r.id for r in clean.collect()) == ["a", "d", "j"]


def test_first_per_key_is_limited_before_the_shuffle(spark):
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 3).alias("disasterNumber"), F.col("id").cast("string").alias("state"),
        F.lit("DR").alias("declarationType"), F.lit("2020-01-02").alias("declarationDate"),
    )
    plan = cleaning.clean_declarations(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


PROJECT = "disasterNumber string, federalShareObligated string, damageCategoryCode string"


def test_projects_keep_positive_amounts(spark):
    rows = [("1", "10.5", "A"), ("1", "4", None), ("1", "0", "A"), ("1", "-3", "A"), ("1", "junk", "B"), (None, "9", "A"), ("2", "NaN", "A"), ("2", "7", "C")]
    usable = cleaning.clean_projects(spark.createDataFrame(rows, PROJECT))
    names = costs.category_names(usable, "damagecategorycode")
    assert names == ["A", "C"]
    cost = {r.disasternumber: r for r in costs.cost_by_disaster(usable, category="damagecategorycode", categories=names).collect()}
    assert cost[1].total_obligated_amount == 14.5 and cost[1].project_count == 2 and cost[1].max_project_cost == 10.5
    assert cost[1].cat_cost_A == 10.5 and cost[1].cat_cost_C == 0.0
    assert cost[2].total_obligated_amount == 7.0 and cost[2].cat_cost_C == 7.0


def test_amount_candidates_in_order_and_error(spark):
    both = spark.createDataFrame([(1, 5.0, 9.0)], "disasternumber long, federalShareObligated double, obligatedAmount double")
    assert cleaning.clean_projects(both).head().obligated_amount == 9.0
    with pytest.raises(ValueError):
        cleaning.clean_projects(spark.createDataFrame([(1,)], "disasternumber long"))


def test_many_categories_lose_no_cost(spark):
    rows = spark.range(50).selectExpr("1L AS disasternumber", "1.0D AS obligated_amount", "cast(id AS string) AS c")
    names = costs.category_names(rows.unionAll(rows.where("c = '7'")), "c", most=10)
    assert len(names) == 10 and "7" in names
    row = costs.cost_by_disaster(rows, category="c", categories=names, rest="cat_cost_other").head()
    assert row.cat_cost_other == 40.0 and row.cat_cost_7 == 1.0
    assert costs.cost_by_category(rows, category="c").count() == 50


def test_summaries_recognise_the_fetched_total(spark):
    rows = [(1, 10.0, "2020-01-02"), (1, 20.0, "2020-01-01"), (2, None, "2020-01-01")]
    got = cleaning.clean_summaries(spark.createDataFrame(rows, "disasterNumber long, totalObligatedAmountPa double, lastRefresh string"))
    assert {r.disasternumber: r.summary_total_obligations for r in got.collect()} == {1: 20.0, 2: None}
    bare = cleaning.clean_summaries(spark.createDataFrame([(1,), (1,)], "disasterNumber long"))
    assert bare.columns == ["disasternumber"] and bare.count() == 1


def test_storm_events_readings_and_stations(spark):
    events = spark.createDataFrame(
        [
            ("48", "C", "1", "28-APR-96 14:30:00", None, "Flood", "1.0", "EG"),
            ("48", "Z", "1", "28-APR-96 14:30:00", None, "Flood", "1.0", "EG"),
            (None, "C", "1", "28-APR-96 14:30:00", None, "Flood", "1.0", "EG"),
            ("48", "C", "1", "bad", None, "Flood", "1.0", "EG"),
        ],
        "STATE_FIPS string, CZ_TYPE string, CZ_FIPS string, BEGIN_DATE_TIME string, END_DATE_TIME string, EVENT_TYPE string, MAGNITUDE string, MAGNITUDE_TYPE string",
    )
    assert [r.place for r in cleaning.clean_storm_events(events).collect()] == ["48001"]
    readings = spark.createDataFrame(
        [("US1", "20200101", "PRCP", 123), ("US1", "20200101", "PRCP", -9999), ("US1", "20200101", "SNOW", 5), ("CA1", "20200101", "PRCP", 5), ("US1", "2020", "PRCP", 5)],
        "ID string, DATE string, ELEMENT string, VALUE long",
    )
    assert [r.precip_mm for r in cleaning.clean_readings(readings).collect()] == [12.3]
    stations = spark.createDataFrame([("US1", " tx"), ("CA1", "ON"), ("US2", None)], "ID string, STATE string")
    assert [tuple(r) for r in cleaning.clean_stations(stations).collect()] == [("US1", "TX")]


def test_regime_and_complete_cases(spark):
    rows = spark.createDataFrame([("Biological", 1.0), (None, 1.0), ("Fire", None)], "kind string, x double")
    assert cleaning.exclude_kind(rows, "kind", "Biological").count() == 2
    assert cleaning.complete_cases(rows, ["x"]).count() == 2
