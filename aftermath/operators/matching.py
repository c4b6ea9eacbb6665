"""Weather matched to incidents by place and date window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aftermath.functions.dates import day_blocks, day_number, in_blocks
from aftermath.session import small_side

# Which magnitudes are wind speeds and which events are floods.
WIND_MAGNITUDES = ("EG", "ES", "MG", "MS")
FLOOD_EVENTS = ("Flood", "Flash Flood", "Coastal Flood", "Lakeshore Flood")
BUFFER_DAYS = 3
LOW_MATCH_PERCENT = 30.0

# Largest block of days used to cover a window: 2^5 = 32.
TOP_BLOCK = 5


# Time is cut into aligned blocks of 2^0 to 2^41 microseconds (25 days) at a place.
WIDEST_LEVEL = 41
# Sides of a block: from a time to its end, from its begin to a time.
SINCE, UPTO = 0, 1


def _micros(time: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(time).cast("timestamp_ntz"))


def with_window(df: DataFrame, begin: str, end: str, days: int = BUFFER_DAYS) -> DataFrame:
    """Add the match window: begin and end (or begin, if open) widened by ``days``."""
    buffer = F.make_dt_interval(F.lit(days))
    return df.withColumns(
        {
            "window_start": F.col(begin) - buffer,
            "window_end": F.coalesce(F.col(end), F.col(begin)) + buffer,
        }
    )


def _bucket(time: Column, width: int) -> Column:
    return F.floor(day_number(time) / F.lit(width)).cast("int")


def _bucketed(df: DataFrame, start: str, end: str, width: int) -> DataFrame:
    """One copy of the row per time bucket its span touches; an inverted span has none."""
    first, last = _bucket(F.col(start), width), _bucket(F.col(end), width)
    return df.where(F.col(start) <= F.col(end)).withColumns(
        {"_bucket": F.explode(F.sequence(first, last)), "_first_bucket": first}
    )


def match_events(
    windows: DataFrame,
    events: DataFrame,
    place: str = "place",
    event_begin: str = "event_begin",
    event_end: str | None = None,
    mode: str = "begin",
    bucket_days: int = 30,
) -> DataFrame:
    """Pairs of a window and an event at the same place.

    ``mode="begin"`` asks that the event begins inside the window, bounds
    included; ``mode="overlap"`` that the two spans overlap. A coarse time
    bucket joins the place as equality key, so that only events near a window
    are compared and a busy place is spread over its buckets.
    """
    # The place key travels under one name on each side.
    spans = _bucketed(windows, "window_start", "window_end", bucket_days)
    if mode == "begin":
        dated = events.withColumn("_bucket", _bucket(F.col(event_begin), bucket_days))
        inside = F.col(event_begin).between(F.col("window_start"), F.col("window_end"))
    elif mode == "overlap":
        stop = F.coalesce(F.col(event_end), F.col(event_begin)) if event_end else F.col(event_begin)
        dated = _bucketed(events.withColumn("_stop", stop), event_begin, "_stop", bucket_days)
        dated = dated.withColumnRenamed("_first_bucket", "_event_first_bucket")
        inside = (
            (F.col(event_begin) <= F.col("window_end"))
            & (F.col("_stop") >= F.col("window_start"))
            # A pair meeting in several buckets is taken in the first one they share.
            & (F.col("_bucket") == F.greatest("_first_bucket", "_event_first_bucket"))
        )
    else:
        raise ValueError(f"unknown match mode '{mode}'")
    # An inner join on the bucketed keys with the exact test as a filter; Catalyst
    # evaluates the filter inside the join.
    return (
        spans.join(dated, [place, "_bucket"])
        .where(inside)
        .drop("_bucket", "_first_bucket", "_event_first_bucket", "_stop")
    )


def storm_measures(wind_kind: str, kind: str, magnitude: str) -> dict[str, Column]:
    """Per event: its wind speed if it is a wind event, and whether it is a flood."""
    return {
        "_wind": F.when(F.col(wind_kind).isin(*WIND_MAGNITUDES), F.col(magnitude)),
        "_flood": F.when(F.col(kind).isin(*FLOOD_EVENTS), F.lit(1)),
    }


def summarise_matches(
    matches: DataFrame, measures: dict[str, Column], key: str = "disasternumber"
) -> DataFrame:
    """Maximum wind, flood count and event count per disaster from matched pairs."""
    return (
        matches.withColumns(measures)
        .groupBy(key)
        .agg(
            F.max("_wind").alias("wind_speed"),
            F.sum("_flood").alias("flood_severity"),
            F.count(F.lit(1)).alias("storm_event_count"),
        )
    )


def _side(side: int, level: Column | int, time: Column) -> Column:
    """The part of the block of ``level`` around ``time`` that lies on one side of it, ``time`` included."""
    level = F.lit(level).cast("int") if isinstance(level, int) else level
    return F.struct(
        F.shiftright(time, WIDEST_LEVEL).alias("_block"),
        (level * 2 + side).alias("_code"),
        F.call_function("shiftright", time, level).alias("_part"),
        (time if side == UPTO else -time).alias("_time"),
    )


def _sides(first: Column, last: Column) -> Column:
    """The sides of blocks that a span of microseconds consists of.

    Within one widest block these are two: the highest bit in which the bounds
    differ names the level at which they lie in neighbouring blocks, and the
    span is the end of one and the begin of the other. A longer span has the
    end of its first widest block, the begin of its last one, and those between.
    """
    apart = first.bitwiseXOR(last)
    level = (F.length(F.bin(apart)) - 1).cast("int")
    block, stop = F.shiftright(first, WIDEST_LEVEL), F.shiftright(last, WIDEST_LEVEL)
    ends = F.shiftleft(F.lit(1).cast("long"), WIDEST_LEVEL)
    # a descending sequence would not be empty
    between = F.when(stop - block > 1, F.sequence(block + 1, stop - 1)).otherwise(F.array().cast("array<bigint>"))
    whole = F.transform(between, lambda b: _side(UPTO, WIDEST_LEVEL, (b + 1) * ends - 1))
    return (
        F.when(first == last, F.array(_side(UPTO, 0, last)))
        .when(block == stop, F.array(_side(SINCE, level, first), _side(UPTO, level, last)))
        .otherwise(F.concat(F.array(_side(SINCE, WIDEST_LEVEL, first), _side(UPTO, WIDEST_LEVEL, last)), whole))
    )


def storm_exposure(
    declarations: DataFrame,
    events: DataFrame,
    measures: dict[str, Column],
    key: str = "disasternumber",
    place: str = "place",
    begin: str = "incidentbegindate",
    end: str = "incidentenddate",
    event_begin: str = "event_begin",
    days: int = BUFFER_DAYS,
) -> DataFrame:
    """What ``summarise_matches(match_events(...))`` gives, without building the pairs.

    Events are first reduced to one row per place and begin time. A window is
    cut into sides of aligned blocks of time, two in most cases, and lies with
    the events in the widest blocks of its place: one shuffle, after which every
    step stays in its task. Events of blocks without a window are left out, the
    others are put at the levels that windows of their block ask for, and a
    running total gives what is on a side. So the work grows with the windows
    and the events, not with their product, and a busy place is spread over its
    blocks.
    """
    spans = (
        declarations.select(key, place, begin, end)
        .dropna(subset=[key, place, begin])
        .distinct()
        .transform(with_window, begin, end, days)
        .where("window_start <= window_end")
    )
    instants = (
        events.dropna(subset=[place, event_begin])
        .withColumns(measures)
        .groupBy(F.col(place).alias("_place"), _micros(event_begin).alias("_time"))
        .agg(
            F.max("_wind").alias("_wind"),
            F.sum("_flood").alias("_flood"),
            F.count(F.lit(1)).alias("_events"),
        )
    )
    # The bounds are columns of their own: a side uses them several times, and conversions of time are slow.
    bounds = {"_first": _micros("window_start"), "_last": _micros("window_end")}
    spans = spans.withColumns(bounds).select(F.col(key).alias("_key"), F.col(place).alias("_place"), *bounds)
    sides = F.explode(_sides(F.col("_first"), F.col("_last"))).alias("_s")
    marks = spans.select("_key", "_place", sides).select("_key", "_place", "_s.*")
    rows = marks.unionByName(instants.withColumn("_block", F.shiftright("_time", WIDEST_LEVEL)), allowMissingColumns=True)
    block = Window.partitionBy("_place", "_block")
    # the events of a block, and the sides that its windows ask for
    rows = rows.withColumns({"_all": F.sum("_events").over(block), "_codes": F.collect_set("_code").over(block)})
    measured = ["_wind", "_flood", "_events"]
    asked = F.when(F.col("_code").isNotNull() & F.col("_all").isNotNull(), F.array("_code")).when(F.col("_code").isNull(), F.col("_codes"))
    lined = rows.withColumn("_at", F.explode(asked))
    side, level = F.col("_at") % 2, F.floor(F.col("_at") / 2).cast("int")
    lined = lined.select(
        "_key",
        "_place",
        "_block",
        F.col("_at").alias("_code"),
        F.coalesce("_part", F.call_function("shiftright", F.col("_time"), level)).alias("_part"),
        F.when(F.col("_key").isNotNull() | (side == UPTO), F.col("_time")).otherwise(-F.col("_time")).alias("_time"),
        *measured,
    )
    upto = Window.partitionBy("_place", "_block", "_code", "_part").orderBy("_time")
    upto = upto.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    found = lined.select(
        "_key",
        F.max("_wind").over(upto).alias("_wind"),
        F.sum("_flood").over(upto).alias("_flood"),
        F.sum("_events").over(upto).alias("_events"),
    )
    return (
        found.where("_key IS NOT NULL AND _events IS NOT NULL")
        .groupBy(F.col("_key").alias(key))
        .agg(
            F.max("_wind").alias("wind_speed"),
            F.sum("_flood").alias("flood_severity"),
            F.sum("_events").alias("storm_event_count"),
        )
    )


def daily_maximum(
    readings: DataFrame, stations: DataFrame, station: str, state: str, day: str, value: str
) -> DataFrame:
    """Highest reading per state and day: at most states x days rows.

    The station list is counted and broadcast if it is small enough, so that
    the readings, the largest input, are reduced before they are shuffled.
    """
    return (
        readings.join(small_side(stations.select(station, state)), station)
        .groupBy(state, day)
        .agg(F.max(value).alias(value))
    )


def rain_exposure(
    declarations: DataFrame,
    daily: DataFrame,
    key: str = "disasternumber",
    state: str = "state",
    begin: str = "incidentbegindate",
    end: str = "incidentenddate",
    day: str = "day",
    value: str = "precip_mm",
    days: int = BUFFER_DAYS,
) -> DataFrame:
    """Highest daily rainfall in the incident's state and window, per disaster.

    A day counts from its midnight: a window that starts later in the day leaves
    that day out. The distinct windows of a state are covered by blocks of days
    and meet the blocks' maxima by equality. The number of blocks and of distinct
    windows depends on the calendar, not on how many readings or declarations a
    state has, and a busy state is spread over its blocks.
    """
    start = F.col("window_start")
    spans = (
        declarations.select(key, state, begin, end)
        .dropna(subset=[key, state, begin])
        .transform(with_window, begin, end, days)
        .select(
            key,
            state,
            F.when(start > start.cast("date"), F.date_add(start.cast("date"), 1))
            .otherwise(start.cast("date"))
            .alias("_first"),
            F.col("window_end").cast("date").alias("_last"),
        )
        .where("_first <= _last")
        .distinct()
    )
    maxima = (
        in_blocks(daily.select(state, day, value), day, TOP_BLOCK)
        .groupBy(state, "_level", "_block")
        .agg(F.max(value).alias(value))
    )
    per_window = (
        day_blocks(spans.select(state, "_first", "_last").distinct(), "_first", "_last", TOP_BLOCK)
        .join(maxima, [state, "_level", "_block"])
        .groupBy(state, "_first", "_last")
        .agg(F.max(value).alias("_rain"))
    )
    return (
        spans.join(per_window, [state, "_first", "_last"])
        .groupBy(key)
        .agg(F.max("_rain").alias("rainfall_intensity"))
        .where("rainfall_intensity IS NOT NULL")
    )


def active_years(declarations: DataFrame, begin: str, end: str, days: int = BUFFER_DAYS) -> list[int]:
    """Years touched by any match window, to prune an archive laid out by year."""
    spans = with_window(declarations.dropna(subset=[begin]), begin, end, days)
    years = (
        spans.where("window_start <= window_end")
        .select(F.year("window_start").alias("a"), F.year("window_end").alias("b"))
        .distinct()
        .select(F.explode(F.sequence("a", "b")).alias("year"))
        .distinct()
    )
    return sorted(row.year for row in years.collect())


def match_rate(everyone: DataFrame, matched: DataFrame, key: str = "disasternumber") -> DataFrame:
    """Distinct matched and distinct total keys, the percentage, and an alarm below 30 %."""
    flagged = (
        everyone.select(key)
        .distinct()
        .join(matched.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    )
    return flagged.agg(
        F.count("_hit").alias("matched"),
        F.count(key).alias("total"),
        F.try_divide(F.count("_hit") * F.lit(100.0), F.count(key)).alias("match_percent"),
    ).withColumn("low", (F.col("match_percent") < LOW_MATCH_PERCENT).cast("int"))


def matched_row_percent(rows: DataFrame, matched: DataFrame, key: str = "disasternumber") -> DataFrame:
    """Percentage of rows whose key has a match."""
    flags = rows.select(key).join(matched.select(key).distinct().withColumn("_hit", F.lit(1)), key, "left")
    return flags.agg((F.avg(F.coalesce("_hit", F.lit(0))) * 100).alias("row_match_percent"))


def combine_exposures(storm: DataFrame, rain: DataFrame, key: str = "disasternumber") -> DataFrame:
    """Full outer join of both exposures: a disaster may have either or both."""
    return storm.join(rain, key, "full")


def newest_versions(listing: DataFrame, name: str, pattern: str, years: Sequence[int]) -> DataFrame:
    """Per year the file with the highest version text, from a directory listing.

    The pattern captures the year and the version; other names are ignored.
    """
    return (
        listing.select(
            F.col(name).alias("file_name"),
            F.regexp_extract(name, pattern, 1).alias("_year"),
            F.regexp_extract(name, pattern, 2).alias("version"),
        )
        .where(F.col("_year") != "")
        .withColumn("year", F.col("_year").cast("int"))
        .where(F.col("year").isin(*years))
        .groupBy("year")
        .agg(F.max_by("file_name", "version").alias("file_name"), F.max("version").alias("version"))
    )
