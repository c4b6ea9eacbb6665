"""Splits, regression metrics and report tables of model evaluation."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.operators.quantiles import exact_quantiles
from aftermath.operators.ranking import keep_first, share_of_total


def hash_bucket(key: Column, buckets: int = 100) -> Column:
    """A bucket that depends on the key alone, so a split survives reruns and repartitioning."""
    return (F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(df: DataFrame, key: str, test_percent: int = 20) -> DataFrame:
    test = hash_bucket(F.col(key)) < test_percent
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def year_split(df: DataFrame, year: str, last_train_year: int) -> DataFrame:
    """Rows up to the year train, later ones test; a null year belongs to neither."""
    return df.withColumn(
        "split",
        F.when(F.col(year) <= last_train_year, "train").when(F.col(year) > last_train_year, "test"),
    )


def split_report(df: DataFrame, year: str) -> DataFrame:
    return (
        df.where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(F.count(F.lit(1)).alias("n"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))
    )


def error_measures(label: str, prediction: str, digits: int | None = 4) -> list[Column]:
    """R2, RMSE and MAE as aggregates of one pass."""
    error = F.col(label) - F.col(prediction)
    explained = 1 - F.sum(error * error) / F.nullif(F.var_pop(label) * F.count(label), F.lit(0.0))
    named = {"r2": explained, "rmse": F.sqrt(F.avg(error * error)), "mae": F.avg(F.abs(error))}
    return [(F.round(v, digits) if digits is not None else v).alias(k) for k, v in named.items()]


def regression_metrics(
    df: DataFrame, label: str, prediction: str, group: Sequence[str] = (), digits: int | None = 4
) -> DataFrame:
    return (
        df.dropna(subset=[label, prediction])
        .groupBy(*group)
        .agg(F.count(F.lit(1)).alias("n"), *error_measures(label, prediction, digits))
    )


def dollar_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Errors, means and exact medians after undoing log1p."""
    dollars = df.dropna(subset=[label, prediction]).select(
        F.expm1(label).alias("actual"), F.expm1(prediction).alias("predicted")
    )
    error = F.col("actual") - F.col("predicted")
    base = dollars.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg("actual").alias("actual_mean"),
        F.avg("predicted").alias("predicted_mean"),
    )
    sides = dollars.select(
        F.explode(
            F.array(
                F.struct(F.lit("actual").alias("side"), F.col("actual").alias("v")),
                F.struct(F.lit("predicted").alias("side"), F.col("predicted").alias("v")),
            )
        ).alias("_s")
    ).select("_s.side", "_s.v")
    medians = exact_quantiles(sides, "v", {"median": 0.5}, ["side"])
    packed = medians.agg(
        F.struct(
            F.max(F.when(F.col("side") == "actual", F.col("median"))).alias("actual"),
            F.max(F.when(F.col("side") == "predicted", F.col("median"))).alias("predicted"),
        ).alias("m")
    ).scalar()
    return (
        base.withColumn("_m", packed)
        .select("*", F.col("_m.actual").alias("actual_median"), F.col("_m.predicted").alias("predicted_median"))
        .drop("_m")
    )


def best_run(runs: DataFrame, name: str, metric: str, group: Sequence[str] = ()) -> DataFrame:
    """The run with the highest metric, per group if given; ties go to the first name."""
    scored = runs.where(F.col(metric).isNotNull())
    return keep_first(scored, list(group), [F.desc(metric), F.asc(name)])


def importance_table(importances: DataFrame) -> DataFrame:
    """(feature, importance) rows ranked, with the percentage of the total."""
    return share_of_total(importances, "importance", [F.desc("importance"), F.asc("feature")])
