"""Whitening and hard negatives by brute force; nulls, odd lengths, ties, repeats, empty tables, clashing columns."""

import math
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from aftermath.llm import negatives, queries, whitening
from tests.compare import DATA, compare, duck

SCHEMA = "vec_id long, embedding array<float>, label int, n long, component string, x int, block int, score double, rank int"
CLASH = (0, "c", 1, 2, 3.0, 4)


def rows_of(vectors, labels=None):
    labels = [0] * len(vectors) if labels is None else labels
    return [(i, None if v is None else [None if c is None else float(c) for c in v], lab, *CLASH) for i, (v, lab) in enumerate(zip(vectors, labels))]


@pytest.fixture(scope="module")
def mess():
    """Gaussian vectors, and such as are left out."""
    rng = np.random.default_rng(5)
    good = rng.normal(size=(500, 12)) @ rng.normal(size=(12, 12)) / 8
    bad = [None, [None] * 12, [1.0] * 11 + [float("nan")], [float("inf")] + [0.0] * 11, [1.0] * 11, []]
    return [v.astype(np.float32) for v in good], bad


def exact_covariance(kept):
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in kept]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    v = np.array(
        [[float(Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3)) for j in range(d)] for i in range(d)]
    )
    return x, n, s, v


def test_whitening_against_exact_sums(spark, mess):
    good, bad = mess
    rows = rows_of(good + bad)
    got = whitening.whitened(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect()
    x, n, s, v = exact_covariance(good)
    values = np.linalg.eigvalsh(v)[::-1]
    assert len(got) == 8 * len(good) and {r.n for r in got} == {n} and {r.vec_id for r in got} == set(range(n))
    table = {(r.vec_id, r.component): r for r in got}
    w = np.array([[table[i, k].whitened for k in range(1, 9)] for i in range(n)])
    for i in range(n):
        assert table[i, 1].deviation == sum((n * a - b) ** 2 for a, b in zip(x[i], s))
    for k in range(8):
        assert table[0, k + 1].explained == pytest.approx(values[k] / np.trace(v), rel=1e-9)
    assert np.abs(w.T @ w / n - np.eye(8)).max() < 1e-9 and got[0].identity_error < 1e-9
    centred = np.array([[float(Fraction(n * a - b, n)) for a, b in zip(r, s)] for r in x])
    axes = np.linalg.eigh(v)[1][:, ::-1][:, :8]
    want = centred @ axes / np.sqrt(values[:8])
    want *= np.sign((want * w).sum(0))
    assert np.abs(w - want).max() < 1e-8


def test_whitening_defined_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whitened(empty).collect() == [] and whitening.whitened(empty).columns == [c.split()[0] for c in whitening.SCHEMA.split(", ")]
    assert whitening.whitened(spark.createDataFrame(rows_of([None, [None], []]), SCHEMA)).collect() == []
    flat = whitening.whitened(spark.createDataFrame(rows_of([[1, 2], [1, 2]]), SCHEMA)).collect()
    assert len(flat) == 4 and all(r.whitened is None and r.explained is None and r.deviation == 0 for r in flat)
    line = whitening.whitened(spark.createDataFrame(rows_of([[0, 0], [1, 1], [1, 1], [2, 2]]), SCHEMA)).collect()
    assert [(r.component, r.whitened is None) for r in sorted(line, key=lambda r: (r.vec_id, r.component))] == [(1, False), (2, True)] * 4
    assert line[0].identity_error < 1e-9
    huge = whitening.whitened(spark.createDataFrame(rows_of([[3e38, 0], [-3e38, 1], [1e8, 2]]), SCHEMA)).collect()
    assert len(huge) == 6 and all((r.whitened is None) == (r.component == 2) for r in huge) and huge[0].identity_error < 1e-4


def test_refinement_of_clustered_values():
    rng = np.random.default_rng(1)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0].astype(np.longdouble)
    turn = whitening.orthonormal(turn)
    values = np.r_[[3.0] * 5, 1 + 1e-10 * np.arange(15), 1e-7 * np.linspace(1, 2, 20)].astype(np.longdouble)
    v = turn @ np.diag(values) @ turn.T
    found, axes = whitening.refined((v + v.T) / 2)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-17
    assert np.abs(axes.T @ axes - np.eye(40)).max() < 1e-17
    assert np.abs(v @ axes - axes * found).max() < 1e-17
    # the values of the tight cluster are told apart: each axis is the one of its value
    inside = np.abs(turn[:, 5:20].T @ axes[:, 5:20])[::-1]
    assert np.abs(np.diag(inside) - 1).max() < 1e-6
    plain = np.linalg.eigh(v.astype(np.float32))[1][:, ::-1]
    assert np.abs(v @ plain - plain * found).max() > 1e-9


def brute_negatives(rows, positives=5, most=10):
    kept = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, lab in rows]
    out = []
    for a, label, q in kept:
        if a % 100:
            continue
        scores = [(-sum(p * y for p, y in zip(q, x)), i, lab) for i, lab, x in kept if i != a]
        for p, pid, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            fits = sorted(s for s in scores if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)
            out += [(a, pid, r, i, -p, -s) for r, (s, i, _) in enumerate(fits[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["mixed", "copies", "sparse", "large"])
def test_negatives_against_brute_force(spark, kind):
    rng = np.random.default_rng(11)
    n, d = 700, 20
    centres = rng.normal(size=(4, d))
    labels = rng.integers(0, 4, n)
    vectors = centres[labels] * 0.3 + rng.normal(size=(n, d)) * 0.2
    if kind == "copies":
        vectors[rng.random(n) < 0.4] = vectors[100]
        labels = rng.integers(0, 3, n)
    if kind == "sparse":
        vectors *= rng.random((n, d)) < 0.2
    if kind == "large":
        vectors *= 1000
    rows = rows_of([v.astype(np.float32) for v in vectors], labels.tolist())
    want = brute_negatives([r[:3] for r in rows])
    rows += [rows[3], rows[100]]  # repeated rows count once
    rows += [(5000, None, 1, *CLASH), (5100, rows[0][1], None, *CLASH), (None, rows[0][1], 1, *CLASH), (5200, rows[0][1][:-1], 1, *CLASH)]
    rows += [(5300, [*rows[0][1][:-1], float("nan")], 1, *CLASH)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for block in (97, 8192) if kind == "mixed" else (97,):
        assert sorted(tuple(r) for r in negatives.mined(df, block_rows=block).collect()) == want


def test_negatives_defined_cases(spark):
    assert negatives.mined(spark.createDataFrame([], SCHEMA)).collect() == []
    no_anchor = [(i, [1.0, 2.0], 1, *CLASH) for i in range(1, 50)]
    assert negatives.mined(spark.createDataFrame(no_anchor, SCHEMA)).collect() == []
    alone = spark.createDataFrame(rows_of([[1.0, 0.0]] * 3, [1, 2, 3]), SCHEMA)  # no positive
    assert negatives.mined(alone).collect() == []
    zero = spark.createDataFrame(rows_of([[1.0, 0.0], [0.0, 1.0], [0.0, 1.0], [0.0, -1.0]], [0, 1, 2, 2]), SCHEMA)
    assert [tuple(r) for r in negatives.mined(zero).collect()] == [(0, 1, 1, 2, 0, 0), (0, 1, 2, 3, 0, 0)]


def test_index_leaves_out_what_cannot_count():
    rng = np.random.default_rng(2)
    x = np.rint(rng.normal(size=(300, 32)) * 200 / np.arange(1, 33)).astype(np.int32)
    index = negatives.Index(np.arange(300), np.zeros(300, int), x)
    q = np.rint(x[:10] * 1.0).astype(np.int32)
    scores = q.astype(np.int64) @ x.T.astype(np.int64)
    for least in (np.full(10, 20000), np.sort(scores, 1)[:, -5], np.full(10, -5)):
        anchor, row, score = index.matches(q, least.astype(np.int64))
        want = {(a, b, scores[a, index.ids[b]]) for a in range(10) for b in range(300) if scores[a, index.ids[b]] >= least[a]}
        assert set(zip(anchor.tolist(), row.tolist(), score.tolist())) == want


def test_negatives_query_against_its_sql(spark):
    folder = DATA / "sf0.01"
    assert compare(queries.op13_negatives(spark, str(folder)), duck(Path(folder)), queries.OP13_NEGATIVES) is None
