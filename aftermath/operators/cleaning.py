"""Cleaning of the three raw tables and the two weather archives."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from aftermath.functions import dates, text
from aftermath.operators.ranking import keep_first
from aftermath.spec import first_present, lower_names

# Declaration types kept, and candidate names of the money columns.
DECLARATION_TYPES = ("DR", "EM", "FM")
AMOUNT_NAMES = ("obligatedamount", "federalshareobligated", "federalsharesobligation")
SUMMARY_NAMES = (
    "totalfederalshareobligations",
    "totalobligations",
    "obligatedamount",
    "totalobligatedamountpa",
)
DATE_COLUMNS = ("declarationdate", "incidentbegindate", "incidentenddate")

# The rainfall element, its missing-value mark and the station prefix.
RAIN_ELEMENT = "PRCP"
MISSING_READING = -9999
STATION_PREFIX = "US"
TENTHS = 10.0


def parse_dates(df: DataFrame, names: Sequence[str] = DATE_COLUMNS) -> DataFrame:
    """Text dates of the named columns, where present, as UTC timestamps."""
    types = dict(df.dtypes)
    return df.withColumns({c: dates.utc_timestamp(F.col(c)) for c in names if types.get(c) == "string"})


def clean_declarations(
    df: DataFrame,
    kinds: Sequence[str] = DECLARATION_TYPES,
    key: str = "disasternumber",
    state: str = "state",
    kind: str = "declarationtype",
    declared: str = "declarationdate",
    arrival: Sequence[str] = ("lastrefresh", "id"),
) -> DataFrame:
    """One dated declaration of an accepted type per (disaster, state).

    Among the county rows of one (disaster, state) the first by ``arrival`` is
    kept, nulls last.
    """
    clean = parse_dates(lower_names(df)).withColumn(key, text.key_number(F.col(key)))
    clean = clean.dropna(subset=[key, declared])
    if kind in clean.columns:
        clean = clean.where(F.col(kind).isin(*kinds))
    order = [F.asc_nulls_last(c) for c in arrival if c in clean.columns]
    # Any further column breaks remaining ties, so the choice does not depend on file order.
    order += [F.asc_nulls_last(c) for c in clean.columns if c not in (*arrival, key, state)]
    return keep_first(clean, [key, state], order)


def clean_projects(
    df: DataFrame, amounts: Sequence[str] = AMOUNT_NAMES, key: str = "disasternumber"
) -> DataFrame:
    """Projects with a positive obligated amount and a disaster key."""
    clean = lower_names(df)
    amount = first_present(clean, list(amounts))
    clean = clean.withColumnRenamed(amount, "obligated_amount")
    return (
        clean.withColumn("obligated_amount", F.coalesce(text.numeric(F.col("obligated_amount")), F.lit(0.0)))
        .where(F.col("obligated_amount") > 0)
        .withColumn(key, text.key_number(F.col(key)))
        .dropna(subset=[key])
    )


def clean_summaries(
    df: DataFrame,
    totals: Sequence[str] = SUMMARY_NAMES,
    key: str = "disasternumber",
    arrival: Sequence[str] = ("lastrefresh", "id"),
) -> DataFrame:
    """Disaster key and reported total, one row per disaster.

    Without a recognised total column only the keys are returned.
    """
    clean = lower_names(df).withColumn(key, text.key_number(F.col(key))).dropna(subset=[key])
    present = [name for name in totals if name in clean.columns]
    if not present:
        return clean.select(key).distinct()
    clean = clean.withColumn("summary_total_obligations", text.numeric(F.col(present[0])))
    order = [F.asc_nulls_last(c) for c in (*arrival, "summary_total_obligations") if c in clean.columns]
    return keep_first(clean, [key], order).select(key, "summary_total_obligations")


def clean_storm_events(df: DataFrame) -> DataFrame:
    """County-level storm events with place key and parsed begin and end."""
    return (
        df.where(F.col("CZ_TYPE") == "C")
        .select(
            text.place_key(F.col("STATE_FIPS"), F.col("CZ_FIPS")).alias("place"),
            dates.two_digit_year_timestamp(F.col("BEGIN_DATE_TIME")).alias("event_begin"),
            dates.two_digit_year_timestamp(F.col("END_DATE_TIME")).alias("event_end"),
            F.col("EVENT_TYPE").alias("event_type"),
            text.numeric(F.col("MAGNITUDE")).alias("magnitude"),
            F.col("MAGNITUDE_TYPE").alias("magnitude_type"),
        )
        .dropna(subset=["place", "event_begin"])
    )


def clean_readings(
    df: DataFrame,
    element: str = RAIN_ELEMENT,
    missing: int = MISSING_READING,
    prefix: str = STATION_PREFIX,
) -> DataFrame:
    """Valid rainfall readings of the wanted stations, in millimetres."""
    return (
        df.where(
            (F.col("ELEMENT") == element) & F.col("ID").startswith(prefix) & (F.col("VALUE") != missing)
        )
        .select(
            F.col("ID").alias("station"),
            dates.compact_date(F.col("DATE")).alias("day"),
            (F.col("VALUE") / F.lit(TENTHS)).alias("precip_mm"),
        )
        .dropna(subset=["day"])
    )


def clean_stations(df: DataFrame, prefix: str = STATION_PREFIX) -> DataFrame:
    """Station id and tidied state of the wanted stations."""
    return (
        df.where(F.col("ID").startswith(prefix))
        .select(F.col("ID").alias("station"), text.tidy(F.col("STATE")).alias("state"))
        .where(F.col("state") != "")
    )


def tidy_text_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Trim and upper-case the named columns; null stays null."""
    return df.withColumns({name: text.tidy(F.col(name)) for name in names})


def exclude_kind(df: DataFrame, kind: str, excluded: str) -> DataFrame:
    """Rows whose kind is not the excluded one; a null kind is kept."""
    return df.where(~F.col(kind).eqNullSafe(F.lit(excluded)))


def complete_cases(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(names))


def county_declarations(df: DataFrame) -> DataFrame:
    """Distinct (disaster, place, begin, end) of all county rows, for weather matching."""
    raw = parse_dates(lower_names(df))
    return (
        raw.select(
            text.key_number(F.col("disasternumber")).alias("disasternumber"),
            text.place_key(F.col("fipsstatecode"), F.col("fipscountycode")).alias("place"),
            "incidentbegindate",
            "incidentenddate",
        )
        .dropna(subset=["disasternumber", "place", "incidentbegindate"])
        .distinct()
    )


def state_declarations(df: DataFrame) -> DataFrame:
    """Distinct (disaster, state, begin, end) of all county rows, for rainfall matching."""
    raw = parse_dates(lower_names(df))
    return (
        raw.select(
            text.key_number(F.col("disasternumber")).alias("disasternumber"),
            text.tidy(F.col("state")).alias("state"),
            "incidentbegindate",
            "incidentenddate",
        )
        .dropna(subset=["disasternumber", "state", "incidentbegindate"])
        .distinct()
    )
