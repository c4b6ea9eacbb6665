"""Weather matching at window edges and against plain joins."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aftermath.operators import matching
from aftermath.plans import exposure

T0 = datetime(2019, 12, 30, 12, 0)


def windows(spark, rows):
    frame = spark.createDataFrame(rows, "disasternumber long, place string, incidentbegindate timestamp, incidentenddate timestamp")
    return frame


def events(spark, rows):
    return spark.createDataFrame(rows, "place string, event_begin timestamp, event_type string, magnitude double, magnitude_type string")


MEASURES = ("magnitude_type", "event_type", "magnitude")


def test_window_bounds_are_closed_and_cross_the_year(spark):
    decl = windows(spark, [(1, "48001", T0, T0 + timedelta(days=4))])
    spans = matching.with_window(decl, "incidentbegindate", "incidentenddate")
    low, high = T0 - timedelta(days=3), T0 + timedelta(days=7)
    second = timedelta(seconds=1)
    hits = events(spark, [("48001", t, "Hail", 1.0, None) for t in (low - second, low, high, high + second)] + [("48003", low, "Hail", 1.0, None)])
    got = matching.match_events(spans, hits)
    assert sorted(r.event_begin for r in got.collect()) == [low, high]


def test_open_end_uses_begin_and_null_place_never_matches(spark):
    decl = windows(spark, [(1, "a", T0, None), (2, None, T0, None)])
    spans = matching.with_window(decl, "incidentbegindate", "incidentenddate")
    hits = events(spark, [("a", T0 + timedelta(days=3), "Hail", 1.0, None), ("a", T0 + timedelta(days=4), "Hail", 1.0, None), (None, T0, "Hail", 1.0, None)])
    assert [r.event_begin for r in matching.match_events(spans, hits).collect()] == [T0 + timedelta(days=3)]


def test_end_before_begin_by_more_than_the_buffer_matches_nothing(spark):
    decl = windows(spark, [(1, "a", T0, T0 - timedelta(days=10))])
    spans = matching.with_window(decl, "incidentbegindate", "incidentenddate")
    assert matching.match_events(spans, events(spark, [("a", T0, "Hail", 1.0, None)])).isEmpty()


def test_two_date_pairs_of_a_county_count_an_event_twice(spark):
    decl = windows(spark, [(1, "a", T0, None), (1, "a", T0, T0), (1, "a", T0, None)])
    hits = events(spark, [("a", T0, "Flood", 7.0, "EG"), ("a", T0, "Hail", 9.0, "XX")])
    row = matching.storm_exposure(decl, hits, matching.storm_measures(*MEASURES)).head()
    assert (row.wind_speed, row.flood_severity, row.storm_event_count) == (7.0, 2, 4)


def test_wind_without_flood_leaves_flood_null(spark):
    row = matching.storm_exposure(windows(spark, [(1, "a", T0, None)]), events(spark, [("a", T0, "Hail", 7.0, "MS")]), matching.storm_measures(*MEASURES)).head()
    assert row.flood_severity is None and row.wind_speed == 7.0


@pytest.fixture(scope="module")
def busy(spark):
    """A third of declarations and events at one place."""
    place = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 11))
    base = F.lit(T0.isoformat(sep=" ")).cast("timestamp")
    decl = spark.range(300).select(
        (F.col("id") % 120).alias("disasternumber"), place.alias("place"), place.alias("state"),
        (base + F.make_dt_interval((F.abs(F.hash("id")) % 400).cast("int"), (F.col("id") % 24).cast("int"))).alias("incidentbegindate"),
        (F.abs(F.hash("id", F.lit(1))) % 60).cast("int").alias("n"),
    ).withColumn("incidentenddate", F.when(F.col("n") > 9, F.col("incidentbegindate") + F.make_dt_interval(days=F.col("n")))).drop("n")
    event = spark.range(900).select(
        "id", place.alias("place"), place.alias("state"),
        (base + F.make_dt_interval((F.abs(F.hash("id", F.lit(2))) % 480).cast("int"), (F.col("id") % 24).cast("int"))).alias("event_begin"),
        F.when(F.col("id") % 5 == 0, "Flood").otherwise("Hail").alias("event_type"),
        (F.col("id") % 77).cast("double").alias("magnitude"),
        F.when(F.col("id") % 2 == 0, "EG").alias("magnitude_type"),
    )
    return decl.cache(), event.cache()


@pytest.mark.parametrize("days", [0, 3, 40])
def test_bucketed_match_and_exposure_equal_the_plain_join(busy, days):
    decl, event = busy
    spans = matching.with_window(decl.select("disasternumber", "place", "incidentbegindate", "incidentenddate").distinct(), "incidentbegindate", "incidentenddate", days)
    plain = spans.join(event.drop("state"), "place").where(F.col("event_begin").between(F.col("window_start"), F.col("window_end")))
    got = matching.match_events(spans, event.drop("state"), bucket_days=7)
    columns = ["disasternumber", "id", "window_start"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    measures = matching.storm_measures(*MEASURES)
    want = matching.summarise_matches(plain, measures)
    exposed = matching.storm_exposure(decl, event, measures, days=days)
    assert sorted(map(tuple, exposed.collect())) == sorted(map(tuple, want.collect()))


def test_match_grows_with_the_buffer(busy):
    decl, event = busy
    counts = []
    for days in (0, 2, 10):
        spans = matching.with_window(decl.select("disasternumber", "place", "incidentbegindate", "incidentenddate"), "incidentbegindate", "incidentenddate", days)
        counts.append(matching.match_events(spans, event.drop("state")).count())
    assert counts == sorted(counts)


def test_overlap_equals_the_plain_join(busy):
    decl, event = busy
    spans = matching.with_window(decl.select("disasternumber", "place", "incidentbegindate", "incidentenddate"), "incidentbegindate", "incidentenddate")
    lasting = event.drop("state").withColumn("event_end", F.col("event_begin") + F.make_dt_interval(days=(F.col("id") % 50).cast("int")))
    plain = spans.join(lasting, "place").where("event_begin <= window_end AND event_end >= window_start AND window_start <= window_end")
    got = matching.match_events(spans, lasting, event_end="event_end", mode="overlap", bucket_days=9)
    columns = ["disasternumber", "id", "window_start"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, plain.select(columns).collect()))
    with pytest.raises(ValueError):
        matching.match_events(spans, lasting, mode="nearest")


def test_rain_equals_the_plain_join_and_excludes_a_partial_first_day(spark, busy):
    decl, event = busy
    daily = event.select("state", F.col("event_begin").cast("date").alias("day"), F.col("magnitude").alias("precip_mm")).groupBy("state", "day").agg(F.max("precip_mm").alias("precip_mm"))
    spans = matching.with_window(decl, "incidentbegindate", "incidentenddate")
    want = (
        spans.join(daily, "state").where(F.col("day").cast("timestamp").between(F.col("window_start"), F.col("window_end")))
        .groupBy("disasternumber").agg(F.max("precip_mm").alias("r"))
    )
    got = matching.rain_exposure(decl, daily)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one = windows(spark, [(1, "TX", T0, T0)]).withColumnRenamed("place", "state")
    first = (T0 - timedelta(days=3)).date()
    days = spark.createDataFrame([("TX", first, 50.0), ("TX", first + timedelta(days=1), 5.0)], "state string, day date, precip_mm double")
    assert matching.rain_exposure(one, days).head().rainfall_intensity == 5.0


def test_rates_and_outer_join(spark):
    everyone = spark.createDataFrame([(1,), (1,), (2,), (3,), (4,)], "disasternumber long")
    matched = spark.createDataFrame([(1, 5.0)], "disasternumber long, wind_speed double")
    rate = matching.match_rate(everyone, matched).head()
    assert (rate.matched, rate.total, rate.match_percent, rate.low) == (1, 4, 25.0, 1)
    assert matching.matched_row_percent(everyone, matched).head()[0] == 40.0
    rain = spark.createDataFrame([(2, 9.0)], "disasternumber long, rainfall_intensity double")
    assert {r.disasternumber for r in matching.combine_exposures(matched, rain).collect()} == {1, 2}


def test_active_years(spark):
    assert matching.active_years(windows(spark, [(1, "a", T0, None), (2, "a", datetime(2023, 1, 2), None)]), "incidentbegindate", "incidentenddate") == [2019, 2020, 2022, 2023]


def test_exposure_job_from_raw_archives(spark):
    decl = spark.createDataFrame(
        [("1", "TX", "48", "1", "2020-01-10T00:00:00.000Z", None), ("2", " tx ", "48", "3", "2020-01-10T00:00:00.000Z", "2020-01-12T00:00:00.000Z"), ("3", "TX", None, "3", "2020-01-10T00:00:00.000Z", None)],
        "disasterNumber string, state string, fipsStateCode string, fipsCountyCode string, incidentBeginDate string, incidentEndDate string",
    )
    storm = spark.createDataFrame(
        [("48", "C", "001", "11-JAN-20 03:00:00", "", "Flood", "60", "EG")],
        "STATE_FIPS string, CZ_TYPE string, CZ_FIPS string, BEGIN_DATE_TIME string, END_DATE_TIME string, EVENT_TYPE string, MAGNITUDE string, MAGNITUDE_TYPE string",
    )
    readings = spark.createDataFrame([("USX", "20200115", "PRCP", 254), ("USX", "20200116", "PRCP", 900)], "ID string, DATE string, ELEMENT string, VALUE long")
    stations = spark.createDataFrame([("USX", "TX")], "ID string, STATE string")
    assert [tuple(r) for r in exposure.storm_table(decl, storm).collect()] == [(1, 60.0, 1, 1)]
    rain = exposure.rain_table(decl, readings, stations)
    assert [tuple(r) for r in rain.collect()] == [(2, 25.4)]
    assert exposure.climate_table(exposure.storm_table(decl, storm), rain).count() == 2


def test_newest_versions(spark):
    from aftermath.sources.archives import STORM_FILE

    names = ["StormEvents_details-ftp_v1.0_d2001_c20200101.csv.gz", "StormEvents_details-ftp_v1.0_d2001_c20210101.csv.gz", "StormEvents_fatalities-ftp_v1.0_d2001_c20220101.csv.gz", "StormEvents_details-ftp_v1.0_d1950_c20210101.csv.gz"]
    listing = spark.createDataFrame([(n,) for n in names], "name string")
    row = matching.newest_versions(listing, "name", STORM_FILE, range(1996, 2027)).collect()
    assert [(r.year, r.version) for r in row] == [(2001, "20210101")]


def test_exposure_deals_its_rows_out_once(spark, busy):
    """Events and windows meet in one shuffle; the others make events and windows distinct and sum up the disasters."""
    decl, event = busy
    exposed = matching.storm_exposure(decl, event, matching.storm_measures(*MEASURES))
    plan = exposed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 4


def test_exposure_of_spans_of_any_length(spark):
    """From an instant over some microseconds to decades, on both sides of 1970."""
    starts = [T0 - timedelta(days=20000), datetime(1969, 12, 31, 23, 59, 59, 999999), T0, T0 + timedelta(microseconds=1)]
    lengths = [timedelta(0), timedelta(microseconds=1), timedelta(hours=7), timedelta(days=1), timedelta(days=26), timedelta(days=9000)]
    spans = [(10 * i + j, "a", s, s + d) for i, s in enumerate(starts) for j, d in enumerate(lengths)]
    times = sorted({t + timedelta(microseconds=m) for _, _, s, e in spans for t in (s, e) for m in (-1, 0, 1)})
    hits = [("a", t, "Flood" if n % 2 else "Hail", float(n * 37 % 101), "EG") for n, t in enumerate(times)]
    exposed = matching.storm_exposure(windows(spark, spans), events(spark, hits), matching.storm_measures(*MEASURES), days=0)
    want = {}
    for key, _, s, e in spans:
        inside = [h for h in hits if s <= h[1] <= e]
        want[key] = (max(h[3] for h in inside), sum(h[2] == "Flood" for h in inside) or None, len(inside))
    assert {r.disasternumber: (r.wind_speed, r.flood_severity, r.storm_event_count) for r in exposed.collect()} == want


def test_storm_exposure_converts_the_bounds_of_a_window_once(spark):
    decl = windows(spark, [(1, "a", T0, None), (2, "b", T0, T0 + timedelta(days=40))])
    hits = events(spark, [("a", T0, "Flood", 7.0, "EG"), ("a", T0, "Flood", 8.0, "EG"), ("b", T0 + timedelta(days=42), "Hail", 9.0, "XX")])
    got = matching.storm_exposure(decl, hits, matching.storm_measures(*MEASURES))
    sides = [line for line in got._jdf.queryExecution().executedPlan().toString().splitlines() if "Generate explode" in line and "_first" in line]
    assert len(sides) == 1 and "timestampdiff" not in sides[0]
    assert sorted(map(tuple, got.collect())) == [(1, 8.0, 2, 2), (2, None, None, 1)]
