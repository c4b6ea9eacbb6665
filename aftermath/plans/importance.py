"""Which features a fitted model relies on."""

import math
import random
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from aftermath.operators import metrics
from aftermath.operators.ranking import with_position
from aftermath.plans import boosting
from aftermath.session import durable

REPEATS = 20


def gain_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """The tree model's own importances, ranked, with percentages; of boosted trees the mean gain per split."""
    if isinstance(model.stages[-1], boosting.RegularizedBoostingModel):
        return gain_importance_of(model.stages[-1], features)
    weights = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(features, weights)]
    table = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return metrics.importance_table(table)


def gain_importance_of(model: boosting.RegularizedBoostingModel, features: Sequence[str]) -> DataFrame:
    """The mean gain of the splits on each feature, over the fitted trees, ranked, with percentages."""
    names = SparkSession.active().createDataFrame(list(enumerate(features)), "feature int, name string")
    return boosting.gain_per_split(model.node_table(), names)


def _shuffles(rows: int, repeats: int, seed: int) -> list[tuple[int, int, int]]:
    """Per repeat a multiplier coprime to the row count and an offset: a one-to-one map of positions."""
    chooser = random.Random(seed)
    drawn = []
    for repeat in range(repeats):
        factor = chooser.randrange(1, min(max(rows, 2), 1_000_003))
        while math.gcd(factor, rows) != 1:
            factor = chooser.randrange(1, min(max(rows, 2), 1_000_003))
        drawn.append((repeat, factor, chooser.randrange(rows)))
    return drawn


def permutation_importance(
    model: PipelineModel,
    test: DataFrame,
    features: Sequence[str],
    target: str,
    key: str,
    repeats: int = REPEATS,
    seed: int = 42,
) -> DataFrame:
    """Loss of R2 when one feature is shuffled: mean and deviation over the repeats.

    Rows are numbered once in hash order. A repeat gives each row a donor row by
    a one-to-one map of the positions, so shuffling needs one join per (row,
    repeat) and no sort per repeat. Each joined row is scored once per feature
    with that feature taken from the donor; scoring and the partial sums happen
    where the join put the row.
    """
    features = list(features)
    mixed = test.select(key, target, *[F.col(f).cast("double").alias(f) for f in features]).withColumn(
        "_mix", F.xxhash64(F.col(key), F.lit(seed))
    )
    numbered = durable(with_position(mixed, ["_mix", key], name="_at").drop("_mix"))
    rows = numbered.count()
    if rows == 0:
        raise ValueError("no rows to test")
    base = metrics.regression_metrics(model.transform(numbered), target, "prediction", digits=None).head().r2

    plans = F.array(
        *[
            F.struct(F.lit(r).alias("r"), F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"))
            for r, a, b in _shuffles(rows, repeats, seed)
        ]
    )
    asked = (
        numbered.withColumn("_plan", F.explode(plans))
        .withColumn("_repeat", F.col("_plan.r"))
        .withColumn("_donor", (F.col("_at") * F.col("_plan.a") + F.col("_plan.b")) % F.lit(rows))
        .drop("_plan", "_at", key)
    )
    donors = numbered.select(F.col("_at").alias("_donor"), *[F.col(f).alias(f"_new_{f}") for f in features])
    paired = asked.join(donors, "_donor").withColumn(
        "_which", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1)))
    )
    shuffled = paired.select(
        target,
        "_repeat",
        "_which",
        *[F.when(F.col("_which") == i, F.col(f"_new_{f}")).otherwise(F.col(f)).alias(f) for i, f in enumerate(features)],
    )
    scores = metrics.regression_metrics(
        model.transform(shuffled), target, "prediction", ["_which", "_repeat"], digits=None
    )
    names = F.array(*[F.lit(f) for f in features])
    return (
        scores.groupBy("_which")
        .agg(
            F.avg(F.lit(base) - F.col("r2")).alias("importance_mean"),
            F.stddev_pop(F.lit(base) - F.col("r2")).alias("importance_std"),
        )
        .select(F.element_at(names, F.col("_which") + 1).alias("feature"), "importance_mean", "importance_std")
        .orderBy(F.desc("importance_mean"), F.asc("feature"))
    )
