"""Timestamps, durations and calendar parts."""

import math

from pyspark.sql import Column, DataFrame, functions as F

MICROS_PER_DAY = 86_400_000_000


def utc_timestamp(value: Column) -> Column:
    """ISO-8601 text as a UTC timestamp; text that does not parse is null."""
    return F.try_to_timestamp(value)


def two_digit_year_timestamp(value: Column) -> Column:
    """``28-APR-96 14:30:00`` with years 69-99 in the 1900s and 00-68 in the 2000s."""
    century = F.when(F.regexp_extract(value, r"^\s*\d{1,2}-[A-Za-z]{3}-(\d{2}) ", 1) >= "69", "19").otherwise("20")
    spelled = F.regexp_replace(
        F.trim(value),
        F.lit(r"^(\d{1,2}-[A-Za-z]{3}-)(\d{2} \d{1,2}:\d{2}:\d{2})$"),
        F.concat(F.lit("$1"), century, F.lit("$2")),
    )
    return F.try_to_timestamp(spelled, F.lit("d-MMM-yyyy H:mm:ss"))


def compact_date(value: Column) -> Column:
    """``yyyyMMdd`` as a date; null if it does not parse.

    Spelled with dashes and cast, which is several times faster than a format
    pattern; readings are the largest input.
    """
    digits = value.cast("string")
    spelled = F.concat_ws("-", F.substring(digits, 1, 4), F.substring(digits, 5, 2), F.substring(digits, 7, 2))
    return F.when(F.length(digits) == 8, spelled.try_cast("date"))


def day_number(value: Column) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(value, F.lit("1970-01-01").cast("date"))


def fractional_days(begin: Column, end: Column) -> Column:
    """Days from begin to end with fractions, not below 0; 0 when either is null."""
    days = F.timestamp_diff("MICROSECOND", begin, end) / F.lit(MICROS_PER_DAY)
    return F.coalesce(F.greatest(days, F.lit(0.0)), F.lit(0.0))


def whole_days(begin: Column, end: Column, as_of: Column) -> Column:
    """Completed days, at least 1; an open incident runs to ``as_of``; null without a begin."""
    micros = F.timestamp_diff("MICROSECOND", begin, F.coalesce(end, as_of))
    days = F.floor(micros / F.lit(MICROS_PER_DAY)).cast("long")
    return F.when(begin.isNotNull(), F.greatest(days, F.lit(1).cast("long")))


def season(month: Column) -> Column:
    """Meteorological season; a null month counts as Autumn, as in the source analysis."""
    return (
        F.when(month.isin(12, 1, 2), "Winter")
        .when(month.isin(3, 4, 5), "Spring")
        .when(month.isin(6, 7, 8), "Summer")
        .otherwise("Autumn")
    )


def on_circle(df: DataFrame, name: str, period: int) -> DataFrame:
    """Add ``<name>_sin`` and ``<name>_cos`` so that the cycle's ends are neighbours."""
    angle = F.col(name) * F.lit(2 * math.pi) / F.lit(period)
    return df.withColumns({f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)})


def calendar_parts(df: DataFrame, date: str, prefix: str = "declaration") -> DataFrame:
    """Year, month and quarter of a date, the latter two also as points on a circle."""
    year, month, quarter = (f"{prefix}_{part}" for part in ("year", "month", "quarter"))
    dated = df.withColumns({year: F.year(date), month: F.month(date), quarter: F.quarter(date)})
    return on_circle(on_circle(dated, month, 12), quarter, 4)


def day_blocks(df: DataFrame, first: str, last: str, top: int) -> DataFrame:
    """Cover the days ``first`` to ``last`` with aligned blocks of 1, 2, 4 ... 2^top days.

    One row per block, as ``_level`` and ``_block`` (day number divided by the
    block length). A span needs about two blocks per level and one per full top
    block, instead of one row per day.
    """
    level = F.col("_level")
    size = F.call_function("shiftleft", F.lit(1), level)
    begin, stop = day_number(F.col(first)), day_number(F.col(last)) + 1
    leveled = df.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumns(
        {
            "_from": F.call_function("shiftright", begin + size - 1, level),
            "_to": F.call_function("shiftright", stop, level),
        }
    )
    low, high = F.col("_from"), F.col("_to")
    # Below the top level only an odd first or last block is not part of a larger one.
    edges = F.array(F.when(low % 2 != 0, low), F.when(high % 2 != 0, high - 1))
    blocks = F.when(level == top, F.sequence(low, high - 1)).otherwise(edges)
    return (
        leveled.where(low < high)
        .withColumn("_block", F.explode(blocks))
        .where(F.col("_block").isNotNull())
        .drop("_from", "_to")
    )


def in_blocks(df: DataFrame, day: str, top: int) -> DataFrame:
    """One row per level for each day, with the block of that level it lies in."""
    leveled = df.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(top))))
    return leveled.withColumn("_block", F.call_function("shiftright", day_number(F.col(day)), F.col("_level")))
