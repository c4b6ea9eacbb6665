"""Embedding whitening: distributed exact covariance, float32 eigenvectors refined in higher precision."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace
from aftermath.llm.vectors import common_width, matrix

SCALE, OFFSET = 1024, 100_000
# Whole numbers are held within this bound (an entry of about a thousand million).
LARGEST = 1 << 40
COMPONENTS = 8
HIGH = np.longdouble
ROUNDS = 40
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whole(values: np.ndarray) -> np.ndarray:
    """Each entry c as the whole number floor(1024 * c) + 100000, within ``LARGEST``."""
    return np.clip(np.floor(SCALE * values) + OFFSET, -LARGEST, LARGEST).astype(np.int64)


def exact_gram(z: np.ndarray) -> np.ndarray:
    """The exact sums of z_i * z_j over the rows of whole numbers, as objects if they need it."""
    if not len(z):
        return np.zeros((z.shape[1], z.shape[1]), np.int64)
    most = int(np.abs(z).max())
    rows = (1 << 53) // max(most * most, 1)
    if rows < 1:  # one product is beyond the whole numbers of a double
        return z.astype(object).T @ z.astype(object)
    parts = [z[at : at + rows].astype(np.float64) for at in range(0, len(z), rows)]
    sums = [np.rint(p.T @ p).astype(np.int64) for p in parts]
    return sums[0] if len(sums) == 1 else np.add.reduce([s.astype(object) for s in sums])


def _cells(cells, values) -> pa.RecordBatch:
    found = pa.array([int(v) for v in values], pa.decimal128(28, 0))
    return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), found], ["cell", "value"])


def _sums(width: int):
    """One row for the number of vectors (cell -1) and one for each dimension's sum."""

    def run(batches):
        n, total = 0, [0] * width
        for batch in batches:
            _, values = matrix(batch.column(0), width)
            n += len(values)
            x = whole(values)
            part = x.sum(0) if len(x) < 1 << 22 else x.astype(object).sum(0)
            total = [a + int(b) for a, b in zip(total, part)]
        if n:
            yield _cells(range(-1, width), [n, *total])

    return run


def _products(width: int, middle: np.ndarray):
    """One row for each cell of the upper triangle of the sums of products around ``middle``."""
    upper = np.triu_indices(width)

    def run(batches):
        total = np.zeros(len(upper[0]), object)
        for batch in batches:
            _, values = matrix(batch.column(0), width)
            total = total + exact_gram(whole(values) - middle)[upper]
        yield _cells(upper[0] * width + upper[1], total)

    return run


def _totals(rows: DataFrame, run) -> dict[int, int]:
    """The summed cells; their number depends on the dimension alone."""
    cells = rows.mapInArrow(run, "cell int, value decimal(28,0)").groupBy("cell").agg(F.sum("value").alias("value"))
    return {r.cell: int(r.value) for r in cells.collect()}


def _high(value: Fraction) -> np.longdouble:
    """A fraction to the precision of ``HIGH``: its double and what that leaves."""
    first = float(value)
    return HIGH(first) + HIGH(float(value - Fraction(first)))


def covariance(n: int, sums: list[int], middle: list[int], products: dict[int, int]) -> np.ndarray:
    """The covariance with divisor n from exact sums, each entry rounded once."""
    width = len(sums)
    rest = [s - n * m for s, m in zip(sums, middle)]
    v = np.zeros((width, width), HIGH)
    for cell, value in products.items():
        i, j = divmod(cell, width)
        v[i, j] = v[j, i] = _high(Fraction(n * value - rest[i] * rest[j], n * n))
    return v


def orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest orthonormal columns of nearly orthonormal ones, by Newton's iteration."""
    eye = np.eye(x.shape[1], dtype=HIGH)
    for _ in range(ROUNDS):
        r = eye - x.T @ x
        x = x + x @ (r / 2)
        if np.abs(r).max() <= 8 * np.finfo(HIGH).eps * len(x):
            break
    return x


def _low(a: np.ndarray) -> np.ndarray:
    """Eigenvectors in float32."""
    return np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)


def solved_inside(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Eigenvectors inside the space of a cluster's columns.

    The part of the matrix in that space, less the cluster's mean eigenvalue and
    scaled to its spread, is solved in float32: its differences, lost in the
    whole matrix, are its leading digits there.
    """
    basis = orthonormal(basis)
    small = basis.T @ (a @ basis)
    small = (small + small.T) / 2
    small = small - np.eye(len(small), dtype=HIGH) * (np.trace(small) / len(small))
    spread = np.abs(small).max()
    if spread <= 4 * np.finfo(HIGH).eps * len(a):
        return basis  # equal to the last digit: any basis of the space will do
    return basis @ orthonormal(_low(small / spread))


def refined(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, both to more than double precision.

    Float32 eigenvectors X are corrected by matrix products in ``HIGH``: with
    R = I - X'X, S = X'AX and the values l = S_ii / (1 - R_ii), X gets X(I + E),
    E_ij = (S_ij + l_j R_ij) / (l_j - l_i), which squares the error. Values
    closer than what S and R still leave open form a cluster: there E_ij =
    R_ij / 2, and its columns are turned by a solve inside their space. The
    digits gained shrink what is open, so clusters fall apart round by round.
    """
    width = len(v)
    scale = np.abs(v).max() if width else HIGH(0)
    if scale == 0:
        return np.zeros(width, HIGH), np.eye(width, dtype=HIGH)
    a, eye, eps = v / scale, np.eye(width, dtype=HIGH), np.finfo(HIGH).eps
    x, size, last = _low(a), np.linalg.norm(a.astype(float)), math.inf
    for _ in range(ROUNDS):
        r, s = eye - x.T @ x, x.T @ (a @ x)
        value = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(value)
        x, value, r, s = x[:, order], value[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        off = s - np.diag(value)
        open_ = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        open_ = max(open_, 8 * eps * size)
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > open_
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        x = x + x @ e
        cuts = np.flatnonzero(np.diff(value) > open_) + 1
        for cluster in np.split(np.arange(width), cuts):
            if len(cluster) > 1:
                x[:, cluster] = solved_inside(a, x[:, cluster])
        left = float(np.abs(np.where(apart, e, 0)).max() + np.abs(r).max())
        if left <= 64 * eps * width or (left < 1e-15 and left >= last):
            break
        last = left
    x = orthonormal(x)
    value = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-value, kind="stable")
    return value[order] * scale, x[:, order]


def _signed(vectors: np.ndarray) -> np.ndarray:
    """The largest entry of each column made positive."""
    at = np.abs(vectors).argmax(0)
    return vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1, 1)


def deviations(z: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """The exact sum of (n * z - rest)^2 of each row; None beyond 64 bits."""
    if not len(z):
        return []
    most = n * int(np.abs(z).max()) + max(map(abs, rest), default=0)
    if most * most * max(z.shape[1], 1) < 1 << 63:
        d = n * z - np.array(rest, np.int64)
        return (d * d).sum(1).tolist()
    d = z.astype(object) * n - np.array(rest, object)
    return [v if v < 1 << 63 else None for v in (d * d).sum(1)]


def _projected(width: int, middle: np.ndarray, n: int, rest: list[int], axes: np.ndarray):
    mean = np.array([float(Fraction(r, n)) for r in rest])

    def run(batches):
        for batch in batches:
            kept, values = matrix(batch.column(1), width)
            z = whole(values) - middle
            along = (z - mean) @ axes
            lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * axes.shape[1], pa.array(along.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept)), pa.array(deviations(z, n, rest), pa.int64()), lists],
                ["vec_id", "deviation", "along"],
            )

    return run


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``vectors`` (vec_id, ``column``).

    One row for each vector and component. Null vectors, vectors with a null or
    non-finite entry and those of another length than most have (of equally
    frequent lengths the longest counts) are dropped. Entries become whole
    numbers x = floor(1024 * c) + 100000, held within 2^40. Every vector that
    is left takes part in the fit. Sums of x and of products around the whole
    mean are exact, so the result does not depend on partitions or lost tasks;
    only they, at most dimension^2 numbers, reach the driver. A dimension in
    the thousands costs minutes there, whatever the rows.

    A component whose eigenvalue is zero beside the largest has no whitened
    value (null) and no part in ``identity_error``. A null vec_id is kept.
    Repeated rows are rows of their own, equal eigenvalues an arbitrary basis.
    An empty table gives no rows. Other columns are ignored, whatever they are
    called. ``deviation`` is null where it is beyond 64 bits.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).alias("vec"))
    width = common_width(rows, "vec")
    counted = _totals(rows.select("vec"), _sums(width)) if width else {}
    n = counted.get(-1, 0)
    if not n:
        return spark.createDataFrame([], SCHEMA)
    sums = [counted[i] for i in range(width)]
    middle = [s // n for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle)]
    centre = np.array(middle, np.int64)
    v = covariance(n, sums, middle, _totals(rows.select("vec"), _products(width, centre)))
    values, axes = refined(v)
    count = min(components, width)
    values, axes, trace = values[:count], _signed(axes[:, :count]), np.trace(v)
    live = values > width * np.finfo(float).eps * max(values[0], 0)
    axes = np.where(live, axes / np.sqrt(np.where(live, values, 1)), np.nan).astype(float)

    space = Workspace(spark, "whitening")
    found = rows.mapInArrow(_projected(width, centre, n, rest, axes), "vec_id long, deviation long, along array<double>")
    found = space.write(found, "projected")
    pairs = [(i, j) for i in range(count) for j in range(i, count) if live[i] and live[j]]
    error = F.lit(None).cast("double")
    if pairs:
        means = found.agg(*(F.avg(F.col("along")[i]).alias(f"m{i}") for i in range(count))).head()
        about = [F.col("along")[i] - F.lit(means[i]) for i in range(count)]
        products = found.agg(*(F.avg(about[i] * about[j]) for i, j in pairs)).head()
        error = F.lit(max(abs(p - (i == j)) for (i, j), p in zip(pairs, products)))
    shares = F.array(*(F.lit(float(x / trace) if trace > 0 else None).cast("double") for x in values))
    return found.select("vec_id", "deviation", F.posexplode("along").alias("at", "value")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(~F.isnan("value"), F.col("value")).alias("whitened"),
        F.get(shares, F.col("at")).alias("explained"),
        error.alias("identity_error"),
    )
