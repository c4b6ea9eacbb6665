"""Regularised second-order boosting of regression trees on binned histograms."""

import json
import random
from dataclasses import dataclass, field

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from aftermath.operators import metrics
from aftermath.operators.ranking import keep_first
from aftermath.session import durable

NODES = (
    "tree int, node int, feature int, threshold double, missing_left boolean, gain double, cover double, rows long, weight double"
)
# A split has to gain more than this before ``gamma`` prunes.
LEAST_GAIN = 1e-6


@dataclass(frozen=True)
class Settings:
    """``l1`` and ``l2`` shrink leaf weights, ``min_child`` is the least hessian sum of a child, ``gamma`` the least gain that stays."""

    rounds: int = 100
    depth: int = 6
    rate: float = 0.1
    l1: float = 0.0
    l2: float = 1.0
    min_child: float = 1.0
    gamma: float = 0.0
    rows: float = 1.0
    features: float = 1.0
    bins: int = 256
    seed: int = 42


def histograms(rows: DataFrame, by: str = "node") -> DataFrame:
    """(by, feature, bin, g, h, n): gradients and hessians of ``rows`` (by, gradient, hessian, bins) per feature and bin.

    ``bins`` has one number for each feature, -1 for a missing value. Rows are
    summed before the shuffle, so that at most one row per node, feature and
    bin leaves a task.
    """
    each = rows.select(by, "gradient", "hessian", F.posexplode("bins").alias("feature", "bin"))
    return each.groupBy(by, "feature", "bin").agg(
        F.sum("gradient").alias("g"), F.sum("hessian").alias("h"), F.count(F.lit(1)).alias("n")
    )


def shrunk(g: Column, l1: float) -> Column:
    return F.signum(g) * F.greatest(F.abs(g) - F.lit(float(l1)), F.lit(0.0))


def candidates(found: DataFrame, settings: Settings = Settings(), by: str = "node") -> DataFrame:
    """Every allowed split (by, feature, bin, missing_left, gain and sums of both sides) of ``histograms``.

    Rows up to ``bin`` go left; those without a value go to either side. The
    gain is that of the leaf scores shrunk(G)^2 / (H + l2).
    """
    group = Window.partitionBy(by, "feature")
    upto = group.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known, names = F.col("bin") >= 0, ("g", "h", "n")
    part = lambda name, kept: F.when(kept, F.col(name)).otherwise(0)
    summed = found.select(
        by,
        "feature",
        "bin",
        *(F.sum(name).over(group).alias(f"_all_{name}") for name in names),
        *(F.sum(part(name, ~known)).over(group).alias(f"_none_{name}") for name in names),
        *(F.sum(part(name, known)).over(upto).alias(f"_left_{name}") for name in names),
    )
    sides = F.explode(F.when(F.col("_none_n") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))))
    sided = summed.where(known).select("*", sides.alias("missing_left"))
    left = {name: F.col(f"_left_{name}") + part(f"_none_{name}", F.col("missing_left")) for name in names}
    sided = sided.select(
        "*",
        *(left[name].alias(f"left_{name}") for name in names),
        *((F.col(f"_all_{name}") - left[name]).alias(f"right_{name}") for name in names),
    )

    def score(side: str) -> Column:
        g = shrunk(F.col(f"{side}_g"), settings.l1)
        return g * g / (F.col(f"{side}_h") + F.lit(float(settings.l2)))

    gain = score("left") + score("right") - score("_all")
    heavy = (F.col("left_h") >= settings.min_child) & (F.col("right_h") >= settings.min_child)
    allowed = sided.where((F.col("left_n") > 0) & (F.col("right_n") > 0) & heavy)
    sums = [f"{side}_{name}" for side in ("left", "right") for name in ("g", "h", "n")]
    return allowed.select(by, "feature", "bin", "missing_left", gain.alias("gain"), *sums)


def best_splits(allowed: DataFrame, by: str = "node") -> DataFrame:
    """The split of the greatest gain of each node; ties go to the first feature and bin."""
    return keep_first(allowed, [by], [F.desc("gain"), F.asc("feature"), F.asc("bin"), F.asc("missing_left")])


def leaf_weight(g: Column, h: Column, settings: Settings) -> Column:
    """The step of a leaf against its gradient."""
    return -F.lit(float(settings.rate)) * shrunk(g, settings.l1) / (h + F.lit(float(settings.l2)))


def bin_edges(df: DataFrame, values: list[Column], bins: int) -> list[list[float]]:
    """Up to ``bins`` - 1 upper bounds of bins of each feature: approximate quantiles, in one aggregation."""
    parts = [i / bins for i in range(1, bins)]
    known = [F.nullif(v.cast("double"), F.lit(float("nan"))) for v in values]
    found = df.agg(*(F.percentile_approx(v, parts, 10_000).alias(f"q{i}") for i, v in enumerate(known))).head()
    return [sorted(set(edges or [])) for edges in found]


def binned(value: Column, edges: list[float]) -> Column:
    """The number of edges below a value, -1 for a missing one; NaN is missing."""
    value = value.cast("double")
    missing = value.isNull() | F.isnan(value)
    if not edges:
        return F.when(missing, -1).otherwise(0)
    return F.when(missing, -1).otherwise(F.size(F.filter(F.lit(edges), lambda edge: edge < value)))


@dataclass
class Tree:
    """One tree by heap places: node n has the children 2n + 1 and 2n + 2. Sums are (g, h, n)."""

    splits: dict[int, dict] = field(default_factory=dict)
    sums: dict[int, tuple] = field(default_factory=dict)

    def pruned(self, gamma: float) -> None:
        """Takes away splits below ``gamma`` whose children are leaves, from the bottom."""
        for node in sorted(self.splits, reverse=True):
            children = (2 * node + 1, 2 * node + 2)
            if self.splits[node]["gain"] < gamma and not any(c in self.splits for c in children):
                del self.splits[node]
                for child in children:
                    self.sums.pop(child)

    def leaf_of(self, node: int) -> int:
        """The leaf that rows of a node belong to after pruning."""
        while node not in self.sums:
            node = (node - 1) // 2
        return node


def _weight(sums: tuple, s: Settings) -> float:
    g, h, _ = sums
    size = max(abs(g) - s.l1, 0.0)
    return -s.rate * (size if g > 0 else -size) / (h + s.l2) if h + s.l2 > 0 else 0.0


def _moved(rows: DataFrame, splits: list) -> DataFrame:
    """Rows of split nodes go on to the children; at most one broadcast row for each node of a level."""
    table = rows.sparkSession.createDataFrame(
        [(r["node"], r["feature"], r["bin"], r["missing_left"]) for r in splits],
        "node int, _feature int, _bin int, _missing_left boolean",
    )
    at = F.get(F.col("bins"), F.col("_feature"))
    right = F.when(at < 0, ~F.col("_missing_left")).otherwise(at > F.col("_bin"))
    child = 2 * F.col("node") + 1 + right.cast("int")
    joined = rows.join(F.broadcast(table), "node", "left")
    return joined.withColumn("node", F.when(F.col("_feature").isNull(), F.col("node")).otherwise(child)).drop(
        "_feature", "_bin", "_missing_left"
    )


def grow(rows: DataFrame, settings: Settings, features: list[int]) -> tuple[Tree, DataFrame]:
    """One tree on ``rows`` (gradient, hessian, bins, drawn), level by level, and the rows with their ``node``.

    A level is one aggregation of the rows of its open nodes; one split for each reaches the driver.
    """
    tree, placed, opened = Tree(), rows.withColumn("node", F.lit(0)), [0]
    for _ in range(settings.depth):
        active = placed.where(F.col("drawn") & F.col("node").isin(opened)) if opened != [0] else placed.where("drawn")
        found = histograms(active)
        if features is not None:
            found = found.where(F.col("feature").isin(features))
        chosen = [r.asDict() for r in best_splits(candidates(found, settings)).where(F.col("gain") > LEAST_GAIN).collect()]
        for r in chosen:
            node = r["node"]
            left, right = ((r[f"{side}_g"], r[f"{side}_h"], r[f"{side}_n"]) for side in ("left", "right"))
            tree.splits[node] = r
            tree.sums.setdefault(node, tuple(a + b for a, b in zip(left, right)))
            tree.sums[2 * node + 1], tree.sums[2 * node + 2] = left, right
        if not chosen:
            break
        placed = _moved(placed, chosen)
        opened = [c for r in chosen for c in (2 * r["node"] + 1, 2 * r["node"] + 2)]
    if 0 not in tree.sums:
        total = placed.where("drawn").agg(F.sum("gradient"), F.sum("hessian"), F.count(F.lit(1))).head()
        tree.sums[0] = (total[0] or 0.0, total[1] or 0.0, total[2])
    tree.pruned(settings.gamma)
    return tree, placed


def fit(df: DataFrame, values: list[Column], target: str, settings: Settings = Settings()) -> tuple[float, DataFrame]:
    """The starting value and the table of nodes of boosted trees for squared error.

    Rows without a target are left out; missing values of a feature follow the
    better side of each split. Every tree reads the rows once for each level
    and once more to move the scores on, which are written to the shared
    folder, so lineage does not grow with the trees. Row and feature draws
    depend on the seed, the tree and the row's values, not on partitions.
    """
    spark = df.sparkSession
    known = df.where(F.col(target).isNotNull() & ~F.isnan(F.col(target).cast("double")))
    edges = bin_edges(known, values, settings.bins)
    start = known.agg(F.avg(F.col(target).cast("double"))).head()[0] or 0.0
    bins = F.array(*(binned(v, e).cast("int") for v, e in zip(values, edges)))
    rows = known.select(F.col(target).cast("double").alias("y"), bins.alias("bins"), F.lit(start).alias("score"))
    rows = durable(rows.withColumn("draw", F.xxhash64("y", "bins")))
    chooser, out = random.Random(settings.seed), []
    for number in range(settings.rounds):
        some = None
        if settings.features < 1:
            some = sorted(chooser.sample(range(len(values)), max(1, round(settings.features * len(values)))))
        drawn = F.lit(True)
        if settings.rows < 1:
            part = F.pmod(F.xxhash64("draw", F.lit(settings.seed), F.lit(number)), F.lit(1 << 20))
            drawn = part < F.lit(int(settings.rows * (1 << 20)))
        gradients = rows.withColumns({"gradient": F.col("score") - F.col("y"), "hessian": F.lit(1.0), "drawn": drawn})
        tree, placed = grow(gradients, settings, some)
        weights = {n: _weight(s, settings) for n, s in tree.sums.items() if n not in tree.splits}
        for n, (_, h, count) in sorted(tree.sums.items()):
            split = tree.splits.get(n)
            if split:
                cuts = edges[split["feature"]]
                cut = cuts[split["bin"]] if split["bin"] < len(cuts) else float("inf")
                out.append((number, n, split["feature"], cut, split["missing_left"], split["gain"], h, count, None))
            else:
                out.append((number, n, None, None, None, None, h, count, weights[n]))
        places = {n for n in range(2 ** (settings.depth + 1) - 1) if n == 0 or n in tree.sums or (n - 1) // 2 in tree.sums}
        reached = [(n, weights[leaf]) for n in sorted(places) if (leaf := tree.leaf_of(n)) in weights]
        steps = spark.createDataFrame(reached, "node int, _step double")
        moved = placed.join(F.broadcast(steps), "node", "left")
        rows = durable(moved.select("y", "bins", (F.col("score") + F.coalesce("_step", F.lit(0.0))).alias("score"), "draw"))
    return start, spark.createDataFrame(out, NODES)


def predicted(x: Column, start: float, nodes: list) -> Column:
    """The prediction for an array of feature values: the trees walked in the JVM, whatever their number."""
    if not nodes:
        return F.lit(float(start))
    width = max(n.node for n in nodes) + 1
    trees = max(n.tree for n in nodes) + 1
    depth = int(np.log2(width + 1))
    size = trees * width
    feature, threshold, left, weight = [-1] * size, [0.0] * size, [True] * size, [0.0] * size
    for n in nodes:
        at = n.tree * width + n.node
        weight[at] = n.weight or 0.0
        if n.feature is not None:
            feature[at], left[at] = n.feature, n.missing_left
            threshold[at] = min(n.threshold, 1.7976931348623157e308)

    def held(values: list, kind: str) -> Column:
        """A constant array, as one literal."""
        return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")

    feature, threshold, left, weight = held(feature, "int"), held(threshold, "double"), held(left, "boolean"), held(weight, "double")

    def step(at: Column, tree: Column) -> Column:
        value = F.get(x, F.get(feature, at))
        right = F.when(value.isNull() | F.isnan(value), ~F.get(left, at)).otherwise(value > F.get(threshold, at))
        node = at - tree * width
        return F.when(F.get(feature, at) < 0, at).otherwise(tree * width + 2 * node + 1 + right.cast("int"))

    def leaf(tree: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), tree * width, lambda at, _: step(at, tree))

    every = F.sequence(F.lit(0), F.lit(trees - 1))
    return F.aggregate(every, F.lit(float(start)), lambda total, tree: total + F.get(weight, leaf(tree)))


def gain_per_split(nodes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(feature, importance, splits, total_gain, rank, importance_pct): the mean gain of a feature's splits, ranked.

    ``names`` (feature, name) puts names in the place of feature numbers.
    """
    split = nodes.where("feature IS NOT NULL")
    if names is not None:
        split = split.join(F.broadcast(names), "feature").withColumn("feature", F.col("name"))
    means = split.groupBy("feature").agg(
        F.avg("gain").alias("importance"), F.count(F.lit(1)).alias("splits"), F.sum("gain").alias("total_gain")
    )
    return metrics.importance_table(means)


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "part of each tree's step that is taken", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "part of the rows drawn for a tree", TypeConverters.toFloat)
    featureRate = Param(Params._dummy(), "featureRate", "part of the features drawn for a tree", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "least hessian sum of a child", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "least gain of a split that stays", TypeConverters.toFloat)
    regAlpha = Param(Params._dummy(), "regAlpha", "L1 term of leaf weights", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 term of leaf weights", TypeConverters.toFloat)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)


class RegularizedBoosting(Estimator, _Shared):
    """``fit`` as a pipeline stage over an assembled vector."""

    @keyword_only
    def __init__(self, **params):
        super().__init__()
        self._setDefault(
            maxIter=100, maxDepth=6, stepSize=0.3, subsamplingRate=1.0, featureRate=1.0, minChildWeight=1.0,
            gamma=0.0, regAlpha=0.0, regLambda=1.0, maxBins=256, seed=42,
        )
        self._set(**self._input_kwargs)

    def settings(self) -> Settings:
        get = self.getOrDefault
        return Settings(
            rounds=get("maxIter"), depth=get("maxDepth"), rate=get("stepSize"), l1=get("regAlpha"), l2=get("regLambda"),
            min_child=get("minChildWeight"), gamma=get("gamma"), rows=get("subsamplingRate"), features=get("featureRate"),
            bins=get("maxBins"), seed=get("seed"),
        )

    def _fit(self, dataset: DataFrame) -> "RegularizedBoostingModel":
        width = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs")
        x = vector_to_array(F.col(self.getFeaturesCol()))
        if width is None:
            width = dataset.agg(F.max(F.size(x))).head()[0] or 0
        rows = dataset.select(F.col(self.getLabelCol()).alias("label"), x.alias("x"))
        start, nodes = fit(rows, [F.get("x", F.lit(i)) for i in range(width)], "label", self.settings())
        model = RegularizedBoostingModel(start, nodes.collect(), width)  # as many rows as the settings allow nodes
        return self._copyValues(model)


class RegularizedBoostingModel(Model, _Shared):
    """The fitted trees."""

    def __init__(self, start: float = 0.0, nodes: list | None = None, width: int = 0):
        super().__init__()
        self.start, self.nodes, self.width = start, nodes or [], width

    def node_table(self) -> DataFrame:
        return SparkSession.active().createDataFrame(self.nodes, NODES)

    def copy(self, extra=None) -> "RegularizedBoostingModel":
        other = super().copy(extra)
        other.start, other.nodes, other.width = self.start, self.nodes, self.width
        return other

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        return dataset.withColumn(self.getPredictionCol(), predicted(x, self.start, self.nodes))
