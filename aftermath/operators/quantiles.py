"""Exact quantiles with linear interpolation for columns of any size and skew."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from aftermath.operators.ranking import same_keys
from aftermath.session import durable, shuffle_width


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    group: Sequence[str] = (),
    parts: int | None = None,
) -> DataFrame:
    """One row per group with a column per requested probability.

    ``percentile`` gathers all distinct values of a group in one task's memory.
    Here equal values are counted first, the distinct values are range
    partitioned, and only the partitions that contain a wanted position are
    read again to pick its value. Null and NaN values are skipped.
    """
    group = list(group)
    parts = parts or shuffle_width(df.sparkSession)
    number = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    counted = (
        df.select(*group, number.alias("_value"))
        .where(F.col("_value").isNotNull())
        .groupBy(*group, "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    placed = durable(
        counted.repartitionByRange(parts, *group, "_value").withColumn("_run", F.spark_partition_id())
    )

    earlier = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    wanted = F.array(
        *[F.struct(F.lit(label).alias("label"), F.lit(float(p)).alias("p")) for label, p in probabilities.items()]
    )
    runs = durable(
        placed.groupBy(*group, "_run")
        .agg(F.sum("_rows").alias("_run_rows"))
        .withColumn("_before", F.coalesce(F.sum("_run_rows").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_run_rows").over(whole))
    )
    targets = (
        runs.withColumn("_want", F.explode(wanted))
        .withColumn("_at", F.col("_want.p") * (F.col("_total") - 1))
        .withColumn("_position", F.explode(F.array_distinct(F.array(F.floor("_at"), F.ceil("_at")))))
        .where((F.col("_position") >= F.col("_before")) & (F.col("_position") < F.col("_before") + F.col("_run_rows")))
        .select(*group, "_run", "_before", "_position", "_at", F.col("_want.label").alias("_label"))
    )

    hit_runs = targets.select(*group, "_run", "_before").distinct()
    hits = (
        placed.alias("p")
        .join(hit_runs.alias("h"), same_keys("p", "h", [*group, "_run"]))
        .select(*[f"p.{column}" for column in [*group, "_run", "_value", "_rows"]], "h._before")
    )
    upto = (
        Window.partitionBy(*group, "_run").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    spans = hits.withColumn("_end", F.col("_before") + F.sum("_rows").over(upto)).withColumn(
        "_start", F.col("_end") - F.col("_rows")
    )
    inside = (F.col("_position") >= F.col("_start")) & (F.col("_position") < F.col("_end"))
    found = (
        targets.alias("t")
        .join(spans.alias("s"), same_keys("t", "s", [*group, "_run"]) & inside)
        .select(
            *[f"t.{column}" for column in group],
            "_label",
            (F.col("_at") - F.floor("_at")).alias("_share"),
            "_value",
        )
    )
    per_label = found.groupBy(*group, "_label").agg(
        (F.min("_value") + (F.max("_value") - F.min("_value")) * F.max("_share")).alias("_quantile")
    )
    return per_label.groupBy(*group).agg(
        *[F.max(F.when(F.col("_label") == label, F.col("_quantile"))).alias(label) for label in probabilities]
    )
