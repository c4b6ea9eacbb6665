"""Scalar rules: padding, dates, durations, lookups, conformance."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aftermath import spec
from aftermath.functions import dates, lookups, text


def one(spark, column, **values):
    names = list(values)
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{n} {t}" for n, t in zip(names, kinds(values))))
    return row.select(column.alias("x")).head().x


def kinds(values):
    table = {str: "string", int: "long", float: "double", datetime: "timestamp", type(None): "string"}
    return [table[type(v)] for v in values.values()]


@pytest.mark.parametrize("value, expected", [("7", "007"), ("12345", "12345"), ("", "000"), (None, None)])
def test_zero_pad_never_cuts(spark, value, expected):
    assert one(spark, text.zero_pad(F.col("v"), 3), v=value) == expected


@pytest.mark.parametrize(
    "state, county, expected",
    [
        ("1", "5", "01005"),
        ("01.0", "5.0", "01005"),
        ("48", "000", "48000"),
        ("48", "12345", "4812345"),
        (None, "5", None),
        ("48", None, None),
        ("x", "5", None),
        ("1.5", "5", None),
    ],
)
def test_place_key(spark, state, county, expected):
    assert one(spark, text.place_key(F.col("s"), F.col("c")), s=state, c=county) == expected


@pytest.mark.parametrize(
    "written, year", [("28-APR-95 14:30:00", 1995), ("1-jan-69 00:00:00", 1969), ("01-Jan-68 00:00:00", 2068), ("05-MAR-24 1:02:03", 2024)]
)
def test_two_digit_years_pivot_at_69(spark, written, year):
    assert one(spark, dates.two_digit_year_timestamp(F.col("v")), v=written).year == year


@pytest.mark.parametrize("written", ["31-FEB-96 10:00:00", "1996-04-28", "", None])
def test_unreadable_storm_dates_are_null(spark, written):
    assert one(spark, dates.two_digit_year_timestamp(F.col("v")), v=written) is None


def test_iso_text_and_compact_dates(spark):
    assert one(spark, dates.utc_timestamp(F.col("v")), v="2024-08-27T18:22:14.800Z") == datetime(2024, 8, 27, 18, 22, 14, 800000)
    assert one(spark, dates.utc_timestamp(F.col("v")), v="not a date") is None
    assert one(spark, dates.compact_date(F.col("v")), v="19961340") is None
    assert str(one(spark, dates.compact_date(F.col("v")), v=19960428)) == "1996-04-28"
    for wrong in ("1996", "199604281", "1996 428", "1996-4-2", "abcdefgh", "19960230", ""):
        assert one(spark, dates.compact_date(F.col("v")), v=wrong) is None, wrong


def test_fractional_days_clip_and_fill(spark):
    begin, end = datetime(2020, 1, 1), datetime(2020, 1, 2, 12)
    assert one(spark, dates.fractional_days(F.col("a"), F.col("b")), a=begin, b=end) == 1.5
    assert one(spark, dates.fractional_days(F.col("a"), F.col("b")), a=end, b=begin) == 0.0
    assert one(spark, dates.fractional_days(F.col("a"), F.lit(None).cast("timestamp")), a=begin) == 0.0


def test_whole_days_run_to_as_of_and_are_at_least_one(spark):
    begin = datetime(2020, 1, 1)
    as_of = F.lit("2020-01-11 06:00:00").cast("timestamp")
    open_end = F.lit(None).cast("timestamp")
    assert one(spark, dates.whole_days(F.col("a"), open_end, as_of), a=begin) == 10
    assert one(spark, dates.whole_days(F.col("a"), F.col("a"), as_of), a=begin) == 1
    assert one(spark, dates.whole_days(open_end, F.col("a"), as_of), a=begin) is None


def test_season_of_null_is_autumn(spark):
    assert one(spark, dates.season(F.col("m")), m=12) == "Winter"
    assert one(spark, dates.season(F.lit(None).cast("int")), m=1) == "Autumn"


def test_day_blocks_cover_each_day_once(spark):
    spans = spark.sql(
        "SELECT id, date_add(DATE '1969-12-20', CAST(id * 7 % 40 AS INT)) AS a, "
        "date_add(DATE '1969-12-20', CAST(id * 7 % 40 + id * 13 % 150 AS INT)) AS b FROM range(60)"
    )
    blocks = dates.day_blocks(spans, "a", "b", 4).select(
        "id", "a", "b", (F.col("_block") * F.pow(F.lit(2), "_level")).cast("int").alias("start"), F.pow(F.lit(2), "_level").cast("int").alias("n")
    )
    days = blocks.select("id", "a", "b", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("d"))
    per = days.groupBy("id", "a", "b").agg(F.count("*").alias("n"), F.count_distinct("d").alias("u"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    wrong = per.where(
        (F.col("n") != F.col("u"))
        | (F.col("n") != F.datediff("b", "a") + 1)
        | (F.col("lo") != F.datediff("a", F.lit("1970-01-01").cast("date")))
    )
    assert per.count() == 60 and wrong.isEmpty()


def test_lookups(spark):
    assert one(spark, lookups.region_of(F.col("s")), s="TX") == "South"
    assert one(spark, lookups.region_of(F.col("s")), s="PR") == "Other"
    assert one(spark, lookups.region_of(F.col("s")), s=None) == "Other"
    assert one(spark, lookups.type_severity(F.col("s")), s="Hurricane") == 1.0
    assert one(spark, lookups.type_severity(F.col("s")), s="Meteor") == 0.0
    assert len(lookups.REGION_OF_STATE) == 51


def test_conform_is_lenient_and_complete(spark):
    raw = spark.createDataFrame([("12", float("nan"), "x")], "` DisasterNumber ` string, totalObligatedAmountPa double, extra string")
    row = spec.conform(raw, spec.DISASTER_SUMMARIES).head()
    assert row.disasterNumber == 12 and row.totalObligatedAmountPa is None and row.lastRefresh is None
    assert "extra" not in row.asDict()


def test_registry_and_candidates(spark):
    assert spec.dataset("declarations").key == "id"
    with pytest.raises(ValueError, match="unknown dataset"):
        spec.dataset("nope")
    df = spark.createDataFrame([(1, 2)], "b int, c int")
    assert spec.first_present(df, ["a", "c", "b"]) == "c"
    with pytest.raises(ValueError, match="none of"):
        spec.first_present(df, ["x"])
    mixed = spark.sql("SELECT 'a' AS s, 1 AS n, DATE '2020-01-01' AS d")
    assert spec.columns_by_kind(mixed) == {"categorical": ["s"], "numeric": ["n"], "date": ["d"]}
