"""Exact positions within a group, without putting a group into one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from aftermath.session import durable, shuffle_width, small_side


def same_keys(left: str, right: str, names: Sequence[str]) -> Column:
    """Null-safe equality of the named columns of two aliased frames."""
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def with_position(
    df: DataFrame,
    order: Sequence[str | Column],
    group: Sequence[str] = (),
    name: str = "position",
    parts: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its group under a total order.

    A ``row_number`` window would sort a whole group in one task, so a group
    holding a third of the table would stall there. Here the rows are range
    partitioned by (group, order), which spreads a large group over many
    partitions. Each partition numbers its own rows; the positions follow from
    the row counts of the partitions before it. The numbered rows are made
    durable so that both uses see the same partition bounds, also after the
    loss of an executor. Rows with a null group key get a null position.
    """
    group, order = list(group), list(order)
    parts = parts or shuffle_width(df.sparkSession)
    placed = durable(
        df.repartitionByRange(parts, *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_run", F.shiftright("_slot", 33))
    )
    earlier = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = small_side(
        placed.groupBy(*group, "_run")
        .agg(F.min("_slot").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .drop("_rows")
    )
    known = F.lit(True)
    for column in group:
        known = known & F.col(column).isNotNull()
    joined = placed.alias("p").join(runs.alias("r"), same_keys("p", "r", [*group, "_run"]))
    return joined.select(
        *[f"p.{column}" for column in df.columns], (F.col("_slot") - F.col("_first") + F.col("_before")).alias(name)
    ).withColumn(name, F.when(known, F.col(name)))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first under ``order``; null keys form one group.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle too, so each map task sends one row per key and a hot key stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def share_of_total(df: DataFrame, value: str, order: Sequence[Column], digits: int = 2) -> DataFrame:
    """Rank rows and give each its percentage of the column total.

    The rank is a global one; it comes from ``with_position``, which runs a job
    when called, so no task orders all rows.
    """
    total = df.agg(F.sum(value)).scalar()
    return with_position(df, order, name="rank").select(
        *df.columns,
        (F.col("rank") + 1).cast("long").alias("rank"),
        F.round(F.try_divide(F.col(value), total) * 100, digits).alias(f"{value}_pct"),
    )
