"""Boosted trees against a plain Newton learner that tries every cut."""

import math
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from aftermath.plans import boosting, importance
from aftermath.plans.boosting import Settings

NAMES = ["a", "b", "c"]


def rows_of(n: int, holes: bool) -> list[tuple]:
    chooser = random.Random(5)
    out = []
    for _ in range(n):
        a, b, c = chooser.random(), float(chooser.randrange(9)), chooser.gauss(0, 1)
        y = 3 * (a > 0.4) + 0.5 * b * (c > 0) + chooser.gauss(0, 0.3)
        out.append((None if holes and chooser.random() < 0.1 else a, b, float("nan") if holes and chooser.random() < 0.1 else c, y))
    return out


def score(g, h, s):
    return max(abs(g) - s.l1, 0) ** 2 / (h + s.l2)


def plain_tree(x, g, s):
    """Nodes by heap place: a split (feature, threshold, missing_left, gain) or a weight."""
    tree, members = {}, {0: list(range(len(x)))}
    for node in range(2**s.depth - 1):
        if node not in members:
            continue
        best, total = None, sum(g[i] for i in members[node])
        for f in range(len(x[0])):
            missing = [i for i in members[node] if x[i][f] is None]
            for cut in sorted({x[i][f] for i in members[node] if x[i][f] is not None}):
                for side in (False, True) if missing else (False,):
                    left = [i for i in members[node] if (x[i][f] is None and side) or (x[i][f] is not None and x[i][f] <= cut)]
                    n, m = len(left), len(members[node])
                    if not 0 < n < m or n < s.min_child or m - n < s.min_child:
                        continue
                    gl = sum(g[i] for i in left)
                    gain = score(gl, n, s) + score(total - gl, m - n, s) - score(total, m, s)
                    if best is None or gain > best[3] + 1e-9:
                        best = (f, cut, side, gain, set(left))
        if best and best[3] > 1e-6:
            tree[node] = best[:4]
            members[2 * node + 1] = [i for i in members[node] if i in best[4]]
            members[2 * node + 2] = [i for i in members[node] if i not in best[4]]
    for node in sorted(tree, reverse=True):
        if tree[node][3] < s.gamma and 2 * node + 1 not in tree and 2 * node + 2 not in tree:
            del tree[node], members[2 * node + 1], members[2 * node + 2]
    steps = [0.0] * len(x)
    for node, inside in members.items():
        if node not in tree:
            total = sum(g[i] for i in inside)
            for i in inside:
                steps[i] = -s.rate * math.copysign(max(abs(total) - s.l1, 0), total) / (len(inside) + s.l2)
    return tree, steps


@pytest.mark.parametrize(
    "settings, holes",
    [
        (Settings(rounds=2, depth=2, rate=0.3), False),
        (Settings(rounds=2, depth=3, rate=0.5, l1=2.0, l2=0.5, min_child=5, gamma=4.0), True),
        (Settings(rounds=1, depth=2, gamma=1e9), False),
    ],
)
def test_trees_equal_those_of_every_cut(spark, settings, holes):
    rows = rows_of(200, holes)
    df = spark.createDataFrame(rows, "a double, b double, c double, y double").repartition(3)
    start, nodes = boosting.fit(df, [F.col(c) for c in NAMES], "y", settings)
    found = nodes.collect()
    assert start == pytest.approx(sum(r[3] for r in rows) / len(rows))
    x = [[None if v is None or v != v else v for v in r[:3]] for r in rows]
    scores = [start] * len(rows)
    for number in range(settings.rounds):
        tree, steps = plain_tree(x, [p - r[3] for p, r in zip(scores, rows)], settings)
        got = {n.node: n for n in found if n.tree == number and n.feature is not None}
        assert set(got) == set(tree)
        for node, (f, cut, side, gain) in tree.items():
            assert got[node].feature == f and got[node].gain == pytest.approx(gain)
            values = sorted({v[f] for v in x if v[f] is not None})
            assert got[node].threshold == cut or not any(min(cut, got[node].threshold) < v <= max(cut, got[node].threshold) for v in values)
        scores = [p + w for p, w in zip(scores, steps)]
    array = F.array(*(F.when(~F.isnan(c), F.col(c)) for c in NAMES))
    out = df.select("a", "b", "c", boosting.predicted(array, start, found).alias("p")).collect()
    want = {(r[0], r[1], None if r[2] != r[2] else r[2]): p for r, p in zip(rows, scores)}
    for r in out:
        assert r.p == pytest.approx(want[r.a, r.b, None if r.c != r.c else r.c], abs=1e-9)


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(rows_of(300, False), "a double, b double, c double, y double")
    settings = Settings(rounds=2, depth=1, rows=0.6, features=0.67)
    tables = [boosting.fit(d, [F.col(c) for c in NAMES], "y", settings)[1].collect() for d in (df.repartition(5), df.coalesce(1))]
    key = lambda table: [(n.tree, n.node, n.feature, n.threshold, n.rows) for n in table]
    assert key(tables[0]) == key(tables[1])
    assert {n.rows for n in tables[0] if n.node == 0} != {300} and all(len({n.feature for n in tables[0] if n.tree == t} - {None}) <= 2 for t in range(2))


def test_stage_in_a_pipeline_and_gain_per_split(spark):
    df = spark.createDataFrame(rows_of(200, False), "a double, b double, c double, y double")
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    model = boosting.RegularizedBoosting(featuresCol="features", labelCol="y", maxIter=2, maxDepth=2, stepSize=0.9).fit(rows)
    error = model.transform(rows).agg(F.avg((F.col("prediction") - F.col("y")) ** 2)).head()[0]
    assert error < df.agg(F.var_pop("y")).head()[0] / 3
    gains = {r.feature: r for r in importance.gain_importance_of(model, NAMES).collect()}
    splits = [n for n in model.nodes if n.feature is not None]
    for i, name in enumerate(NAMES):
        own = [n.gain for n in splits if n.feature == i]
        if own:
            assert gains[name].importance == pytest.approx(sum(own) / len(own)) and gains[name].splits == len(own)


def test_gain_per_split_of_two_trees_by_hand(spark):
    rows = [(0, 0, 0, 1.0, True, 10.0, 9.0, 9, None), (0, 1, 1, 1.0, True, 4.0, 5.0, 5, None), (0, 2, None, None, None, None, 4.0, 4, 0.1)]
    rows += [(1, 0, 0, 1.0, True, 2.0, 9.0, 9, None)]
    got = [(r.feature, r.importance, r.splits, r.total_gain, r.rank, r.importance_pct) for r in boosting.gain_per_split(spark.createDataFrame(rows, boosting.NODES)).collect()]
    assert sorted(got) == [(0, 6.0, 2, 12.0, 1, 60.0), (1, 4.0, 1, 4.0, 2, 40.0)]


def test_empty_and_constant_tables(spark):
    for rows in ([], [(1.0, 1.0, 1.0, 2.0)] * 4, [(None, None, None, 2.0), (None, None, None, 3.0)]):
        df = spark.createDataFrame(rows, "a double, b double, c double, y double")
        start, nodes = boosting.fit(df, [F.col(c) for c in NAMES], "y", Settings(rounds=1, depth=2))
        assert nodes.where("feature IS NOT NULL").isEmpty()
        assert df.select(boosting.predicted(F.array(*NAMES), start, nodes.collect()).alias("p")).where(F.abs(F.col("p") - start) > 1e-9).isEmpty()
