"""Exploratory summaries."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from aftermath.operators.quantiles import exact_quantiles
from aftermath.operators.ranking import same_keys
from aftermath.session import small_side

# A table is at most so many labels wide; what is beyond is counted together.
WIDEST = 1000

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count per value and column, nulls included."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    return df.select(pairs.alias("_p")).groupBy("_p.column", "_p.value").agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, labels: Sequence[str] | None = None, rest: str = "other") -> DataFrame:
    """Counts with one row per ``row`` value and one column per label, 0 where absent.

    Without ``labels`` the ``WIDEST`` most frequent ones in ``df`` are taken, in
    order; that runs a job. Column ``rest`` counts every other label and null,
    so the columns of a row add up to its rows.
    """
    if labels is None:
        counted = df.where(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(column).count()
        found = counted.orderBy(F.desc("count"), F.asc(column)).limit(WIDEST).collect()
        labels = sorted(r[0] for r in found)
    listed = F.coalesce(F.col(column).isin(*labels), F.lit(False)) if labels else F.lit(False)
    return (
        df.where(F.col(row).isNotNull())
        .groupBy(row)
        .agg(*[F.count_if(F.col(column) == label).alias(label) for label in labels], F.count_if(~listed).alias(rest))
    )


def row_shares(df: DataFrame, row: str, column: str) -> DataFrame:
    """Share of each (row, column) pair in its row, in long form.

    The window runs over the counted pairs, not over the data.
    """
    counted = df.dropna(subset=[row, column]).groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))


def group_size(df: DataFrame, group: str, name: str) -> DataFrame:
    """Give each row the size of its group; rows with a null group are left out.

    The sizes come from a partial aggregation and are joined back. A window
    count would hold all rows of a large group in one task.
    """
    sizes = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias(name))
    return df.join(small_side(sizes), group)


def mean_by(df: DataFrame, group: str, value: str, name: str) -> DataFrame:
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(F.avg(value).alias(name))


def describe(df: DataFrame, value: str, group: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum; nulls and NaN skipped."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    clean = df.select(*group, number.alias(value))
    moments = clean.groupBy(*group).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quartiles = exact_quantiles(clean, value, QUARTILES, group)
    if not group:
        packed = quartiles.select(F.struct(*QUARTILES).alias("q")).scalar()
        return moments.withColumn("_q", packed).select("*", *[F.col(f"_q.{q}").alias(q) for q in QUARTILES]).drop("_q")
    joined = moments.alias("m").join(quartiles.alias("q"), same_keys("m", "q", group), "left")
    return joined.select(*[f"m.{c}" for c in moments.columns], *[f"q.{q}" for q in QUARTILES])


def box_numbers(df: DataFrame, group: str, value: str) -> DataFrame:
    """Quartiles, whisker ends (furthest value within 1.5 box lengths) and outlier count per group."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    clean = df.select(group, number.alias(value)).dropna()
    boxes = exact_quantiles(clean, value, QUARTILES, [group])
    fenced = clean.join(small_side(boxes), group).withColumns(
        {
            "_low": F.col("q25") - 1.5 * (F.col("q75") - F.col("q25")),
            "_high": F.col("q75") + 1.5 * (F.col("q75") - F.col("q25")),
        }
    )
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    return fenced.groupBy(group).agg(
        F.count(value).alias("n"),
        *[F.min(q).alias(q) for q in QUARTILES],
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def histogram(df: DataFrame, value: str, bins: int = 40) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, the last one closed.

    Empty bins are listed with 0, as a plot needs them.
    """
    clean = df.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL AND NOT isnan(_v)")
    packed = clean.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high")).alias("b")).scalar()
    place = F.floor((F.col("_v") - F.col("_b.low")) * bins / F.nullif(F.col("_b.high") - F.col("_b.low"), F.lit(0.0)))
    counted = (
        clean.withColumn("_b", packed)
        .withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("_b", packed)
    width = (F.col("_b.high") - F.col("_b.low")) / bins
    return (
        frame.join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("_b.low") + F.col("bin") * width).alias("bin_start"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: type, rows, nulls, distinct values.

    All columns are read in one pass; distinct values are counted on
    (column, value text) pairs, so no column is gathered in one place.
    """
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    counted = df.select(pairs.alias("_p")).groupBy("_p.column", "_p.value").agg(F.count(F.lit(1)).alias("n"))
    kind = reduce(lambda made, c: made.when(F.col("column") == c, types[c]), columns, F.when(F.lit(False), ""))
    return (
        counted.groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
            F.count("value").alias("distinct_values"),
        )
        .withColumn("type", kind)
    )


def quality_gate(df: DataFrame | None, required: Sequence[str]) -> dict:
    """Whether a dataset is there, has rows and has the required columns."""
    missing = [c for c in required if df is None or c not in df.columns]
    filled = df is not None and not df.isEmpty()
    return {
        "exists": df is not None,
        "non_empty": filled,
        "missing_columns": missing,
        "ok": filled and not missing,
    }


def null_counts(df: DataFrame) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
