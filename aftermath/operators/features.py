"""Feature columns per (disaster, state)."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from aftermath.functions import dates, lookups
from aftermath.functions.text import slug
from aftermath.operators.ranking import with_position
from aftermath.session import durable

CLIMATE_COLUMNS = ("rainfall_intensity", "wind_speed", "flood_severity")

# Weights of the severity blend, guard of the scaling, thresholds.
TYPE_WEIGHT = 0.6
CLIMATE_WEIGHT = 0.4
SCALE_GUARD = 1e-9
DISCREPANCY_LIMIT = 0.20
HIGH_COST = 10_000_000
TOP_TYPES = 10


def incident_times(df: DataFrame, declared: str, begin: str, end: str) -> DataFrame:
    """Incident duration and days from begin to declaration, both in days and not negative."""
    return df.withColumns(
        {
            "incident_duration_days": dates.fractional_days(F.col(begin), F.col(end)),
            "days_to_declaration": dates.fractional_days(F.col(begin), F.col(declared)),
        }
    )


def prior_events(df: DataFrame, state: str, declared: str, key: str) -> DataFrame:
    """Number of earlier declarations of the same state: no row sees its own future."""
    return with_position(df, [declared, key], [state], "state_disaster_frequency")


def attach_climate(df: DataFrame, climate: DataFrame, key: str) -> DataFrame:
    """Left join of the exposures; missing measures are 0, a missing event count stays null."""
    joined = df.join(climate, key, "left")
    return joined.fillna({c: 0 for c in CLIMATE_COLUMNS if c in joined.columns})


def scaling_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of minima and maxima, to scale this table or a later one by."""
    return df.agg(
        *[F.min(c).cast("double").alias(f"{c}_low") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}_high") for c in columns],
    )


def blend_severity(df: DataFrame, kind_severity, columns: Sequence[str], bounds: DataFrame | None = None) -> DataFrame:
    """0.6 x type severity + 0.4 x mean of the min-max scaled climate columns.

    ``bounds`` defaults to those of ``df``, which is written out then because it
    is read twice; pass the bounds of a training period to keep later rows from
    influencing it. The one-row bounds enter as a scalar subquery, not as a join
    or a window over the whole table.
    """
    if not columns:
        return df.withColumn("incident_severity_score", kind_severity)
    if bounds is None:
        df = durable(df)
        bounds = scaling_bounds(df, columns)
    packed = bounds.select(F.struct(*bounds.columns).alias("bounds")).scalar()
    scaled = [
        (F.col(c) - F.col(f"_bounds.{c}_low"))
        / (F.col(f"_bounds.{c}_high") - F.col(f"_bounds.{c}_low") + F.lit(SCALE_GUARD))
        for c in columns
    ]
    mean = sum(scaled[1:], scaled[0]) / F.lit(len(scaled))
    return (
        df.withColumn("_bounds", packed)
        .withColumn("incident_severity_score", F.lit(TYPE_WEIGHT) * kind_severity + F.lit(CLIMATE_WEIGHT) * mean)
        .drop("_bounds")
    )


def top_labels(df: DataFrame, column: str, most: int) -> DataFrame:
    """The ``most`` frequent non-null labels with counts; ties by label."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(most)
    )


def one_hot(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """A 0/1 column ``is_<label>`` per label; a null value is 0 everywhere."""
    return df.withColumns(
        {f"is_{slug(label)}": F.col(column).eqNullSafe(F.lit(label)).cast("int") for label in labels}
    )


def interactions(df: DataFrame) -> DataFrame:
    severity, duration = F.col("incident_severity_score"), F.col("incident_duration_days")
    return df.withColumns(
        {
            "severity_x_duration": severity * duration,
            "severity_x_frequency": severity * F.col("state_disaster_frequency"),
            "duration_x_days_to_declaration": duration * F.col("days_to_declaration"),
        }
    )


def with_discrepancy(df: DataFrame, total: str, reported: str) -> DataFrame:
    """Relative gap between our total and the reported one, flagged above 20 %.

    A reported total of 0 or null gives a null gap and a flag of 0.
    """
    gap = F.abs(F.col(total) - F.col(reported)) / F.nullif(F.col(reported), F.lit(0.0))
    return df.withColumn("obligation_discrepancy", gap).withColumn(
        "high_discrepancy_flag",
        F.coalesce((F.col("obligation_discrepancy") > DISCREPANCY_LIMIT).cast("int"), F.lit(0)),
    )


def high_cost_flag(df: DataFrame, total: str, limit: float = HIGH_COST) -> DataFrame:
    return df.withColumn("high_cost_disaster", F.coalesce((F.col(total) > limit).cast("int"), F.lit(0)))


def category_code(df: DataFrame, column: str, code: str, labels: Sequence[str] | None = None) -> DataFrame:
    """Alphabetical 0-based code of a column. Null is -1, as is a label not in ``labels``.

    By default codes count the labels present in ``df``, so they shift when one
    is absent; pass ``labels`` for codes that stay put. The labels present may
    be many: they are numbered by ``with_position``, which runs a job when
    called, and joined back.
    """
    if labels is None:
        present = with_position(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], name=code)
        joined = df.join(present, column, "left")
        return joined.select(*df.columns, F.coalesce(F.col(code).cast("int"), F.lit(-1)).alias(code))
    present = F.array(*[F.lit(label) for label in sorted(labels)])
    return df.withColumn(
        code, F.coalesce((F.array_position(present, F.col(column)) - 1).cast("int"), F.lit(-1))
    )


def state_region(df: DataFrame, state: str) -> DataFrame:
    return df.withColumn("region", lookups.region_of(F.col(state)))
