"""Hard negatives by threshold joins: an inverted index cut by suffix norms, partial scores, falling thresholds."""

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from aftermath.llm.shared import Workspace
from aftermath.llm.vectors import common_width, matrix

SCALE = 256
# Whole numbers are held within this bound (an entry of about half a million).
LARGEST = 1 << 27
LABELS, SHIFTED = 10, 7
EVERY = 100
POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between these hundredths of the positive's.
LEAST, MOST = 30, 90
# Hundredths of the positive's score from which on negatives are looked for, turn by turn.
TURNS = (80, 65, 50, 40, LEAST)
# Rows indexed together, anchors matched together and dimensions listed together.
BLOCK_ROWS, CHUNK, GROUP = 8192, 256, 8
FOUND = "anchor_id long, place int, other_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def participants(vectors: DataFrame, width: int, column: str) -> DataFrame:
    """(vec_id, label, x) of the rows that take part, one for each id; x are whole numbers."""

    def run(batches):
        for batch in batches:
            kept, values = matrix(batch.column(2), width)
            x = np.clip(np.floor(SCALE * values), -LARGEST, LARGEST).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(x.ravel()))
            at = pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), lists], ["vec_id", "label", "x"])

    known = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col(column).alias("vec")
    )
    known = known.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    found = known.mapInArrow(run, "vec_id long, label int, x array<int>")
    one = found.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("one"))
    shifted = F.when(F.col("vec_id") % SHIFTED == 0, (F.col("one.label") + 1) % LABELS).otherwise(F.col("one.label"))
    return one.select("vec_id", shifted.alias("label"), F.col("one.x").alias("x"))


class Index:
    """Rows of a block, listed by dimension as far as each row's dimensions count.

    Dimensions are taken in groups, those with the most weight in the block
    first. Of a row only leading groups are listed: the others are left out
    where the norm of what follows, times that of the same part of any anchor,
    is below the anchor's threshold, so that they can make no result alone.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.whole = ids[by_id], labels[by_id], x[by_id]
        values = self.whole.astype(np.float64)
        self.order = np.argsort(-(values * values).sum(0), kind="stable")
        self.x = np.ascontiguousarray(values[:, self.order])
        self.cuts = [slice(i, min(i + GROUP, x.shape[1])) for i in range(0, x.shape[1], GROUP)]
        self.rest = self.norms(self.x)

    def norms(self, x: np.ndarray) -> np.ndarray:
        """The norm of each row from each group on, rounded up; that after the last one is zero."""
        squares = np.zeros((len(x), len(self.cuts) + 1))
        for i in reversed(range(len(self.cuts))):
            part = x[:, self.cuts[i]]
            squares[:, i] = squares[:, i + 1] + (part * part).sum(1)
        return np.sqrt(squares) * (1 + 1e-9)

    def exact(self, q: np.ndarray) -> bool:
        """Whether all scores are whole numbers of a double."""
        most = float(np.abs(q).max(initial=0)) * float(np.abs(self.x).max(initial=0))
        return most * q.shape[1] < 1 << 53

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The scores of all pairs of anchors and ``rows``."""
        if self.exact(q):
            return np.rint(q.astype(np.float64) @ self.whole[rows].astype(np.float64).T).astype(np.int64)
        return q.astype(np.int64) @ self.whole[rows].astype(np.int64).T

    def matches(self, q: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of all pairs whose score is the anchor's ``least`` or more."""
        turned = q[:, self.order].astype(np.float64)
        rest, slack = self.norms(turned), 0.5 + 1e-9 * np.abs(least)[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            reach = np.where(least[:, None] > 0, rest / least[:, None], np.inf).max(0, initial=0)
            listed = ~(self.rest[:, :-1] * reach[None, :-1] < 1)
        depth = np.minimum.accumulate(listed, axis=1).sum(1)
        rows = np.argsort(-depth, kind="stable")
        rows = rows[depth[rows] > 0]  # the others cannot reach any threshold
        partial, alive = np.zeros((len(q), len(rows))), np.ones((len(q), len(rows)), bool)
        for g, cut in enumerate(self.cuts):
            n = np.searchsorted(-depth[rows], -g)  # rows that this group lists: those of greater depth
            if n == 0:
                break
            partial[:, :n] += turned[:, cut] @ self.x[rows[:n], cut].T
            ahead = rest[:, g + 1, None] * self.rest[rows[:n], g + 1][None, :]
            alive[:, :n] &= partial[:, :n] + ahead >= least[:, None] - slack
            open_ = alive.any(0)
            if open_.sum() <= 0.75 * len(rows):
                rows, partial, alive = rows[open_], partial[:, open_], alive[:, open_]
        for d in np.unique(depth[rows]):  # what the lists left out of the rows still open
            some = np.flatnonzero((depth[rows] == d) & alive.any(0))
            start = d * GROUP
            partial[:, some] += turned[:, start:] @ self.x[rows[some], start:].T
        anchor, at = np.nonzero(alive & (partial >= least[:, None] - slack))
        if self.exact(q):
            score = np.rint(partial[anchor, at]).astype(np.int64)
        else:
            score = (q[anchor].astype(np.int64) * self.whole[rows[at]]).sum(1)
        right = score >= least[anchor]
        return anchor[right], rows[at[right]], score[right]


def _rows_of(anchor: list, place: list, other: list, score: list) -> pa.RecordBatch:
    columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (anchor, place, other, score)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(columns[2]), pa.array(columns[3])],
        ["anchor_id", "place", "other_id", "score"],
    )


def _positives(most: int) -> Callable:
    """The first rows of an anchor's label in a block; places number them."""

    def run(index: Index, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, _) -> pa.RecordBatch:
        out = [], [], [], []
        for label in np.unique(labels):
            rows = np.flatnonzero(index.labels == label)
            mine = np.flatnonzero(labels == label)
            scores = index.scores(q[mine], rows)
            for i, a in enumerate(mine):
                other = rows[index.ids[rows] != ids[a]]
                score = scores[i][index.ids[rows] != ids[a]]
                first = np.argsort(-score, kind="stable")[:most]  # equal scores stay in order of id
                for column, values in zip(out, (np.full(len(first), ids[a]), np.arange(len(first)), index.ids[other[first]], score[first])):
                    column.append(values)
        return _rows_of(*out)

    return run


def _negatives(most: int) -> Callable:
    """For each window of an anchor the first rows of other labels in a block."""

    def run(index: Index, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, windows: list) -> pa.RecordBatch:
        least = np.array([min(w["least"] for w in some) for some in windows], np.int64)
        anchor, row, score = index.matches(q, least)
        other = index.labels[row] != labels[anchor]
        anchor, row, score = anchor[other], row[other], score[other]
        order = np.lexsort((index.ids[row], -score, anchor))
        anchor, row, score = anchor[order], row[order], score[order]
        begin = np.searchsorted(anchor, np.arange(len(ids) + 1))
        out = [], [], [], []
        for a, some in enumerate(windows):
            falling = -score[begin[a] : begin[a + 1]]
            for w in some:
                i = np.searchsorted(falling, -w["high"])
                j = min(np.searchsorted(falling, -w["least"], "right"), i + most)
                at = slice(begin[a] + i, begin[a] + max(i, j))
                n = at.stop - at.start
                for column, values in zip(out, (np.full(n, ids[a]), np.full(n, w["place"]), index.ids[row[at]], score[at])):
                    column.append(values)
        return _rows_of(*out)

    return run


def _blockwise(width: int, step: Callable) -> Callable[[Iterator], Iterator]:
    """Runs ``step`` for each block on its index and its anchors, a chunk at a time.

    The batches hold whole blocks, rows before anchors; one block and one chunk are in memory.
    """

    def parts(batches):
        for batch in batches:
            block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
                if b > a:
                    part = batch.slice(a, b - a)
                    lists = part.column(4)
                    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(b - a, width)
                    ids, labels = part.column(2).to_numpy(), part.column(3).to_numpy()
                    yield int(block[a]), int(kind[a]), ids, labels, x, part.column(5)

    def run(batches):
        current, held, index = None, [], None
        for block, kind, ids, labels, x, windows in parts(batches):
            if block != current:
                current, held, index = block, [], None
            if kind == 0:
                held.append((ids, labels, x))
                continue
            if index is None:
                if not held:
                    continue  # no rows in this block
                index, held = Index(*(np.concatenate(c) for c in zip(*held))), []
            for at in range(0, len(ids), CHUNK):
                some = slice(at, at + CHUNK)
                yield step(index, ids[some], labels[some], x[some], windows.slice(at, CHUNK).to_pylist())

    return run


def _against(rows: DataFrame, asks: DataFrame, blocks: int, width: int, step: Callable) -> DataFrame:
    """``step`` of every ask (vec_id, label, x, windows) against every block of the written ``rows``.

    The asks are the stated query set: each goes to each block by its number.
    """
    kind = "array<struct<place:int,least:bigint,high:bigint>>"
    stored = rows.select("block", F.lit(0).alias("kind"), "vec_id", "label", "x", F.lit(None).cast(kind).alias("windows"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    asked = asks.select(every.alias("block"), F.lit(1).alias("kind"), "vec_id", "label", "x", F.col("windows").cast(kind).alias("windows"))
    dealt = stored.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind", "vec_id")
    return dealt.mapInArrow(_blockwise(width, step), FOUND)


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first rows of each group by falling score, then id; ``rank`` numbers them."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mined(
    vectors: DataFrame,
    column: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    every: int = EVERY,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors`` (vec_id, label, ``column``).

    Anchors are the ids divisible by ``every``. Each is matched with all rows, in
    blocks of about ``block_rows``. Its positives are its first rows of the same
    label; for each of these the first rows of other labels between ``LEAST``
    and ``MOST`` hundredths of the positive's score are its negatives. The
    search starts at a high threshold; anchors with a window that is not full
    are searched again at the next of ``TURNS``, so the last turn settles all.

    Rows with a null id, label or vector, with a null or non-finite entry, or of
    another length than most vectors (of equally frequent lengths the longest
    counts) take no part. Whole numbers are held within 2^27. Of the rows of
    one id the one with the smallest label, then vector, counts, so repeated
    rows count once. Equal scores are ordered by id. A positive of negative
    score has no negatives. An empty table, or one without anchors, gives no
    rows. Other columns are ignored, whatever they are called.
    """
    spark = vectors.sparkSession
    width = common_width(vectors, column)
    if not width:
        return spark.createDataFrame([], RESULT)
    space = Workspace(spark, "negatives")
    rows = space.write(participants(vectors, width, column), "rows")
    blocks = max(1, math.ceil(rows.count() / block_rows))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    anchors = rows.where(F.col("vec_id") % every == 0).select("vec_id", "label", "x")
    near = _against(rows, anchors.withColumn("windows", F.lit(None)), blocks, width, _positives(positives))
    near = _first(near, ["anchor_id"], positives)
    near = space.write(near.select("anchor_id", F.col("rank").alias("place"), "other_id", "score"), "positives")
    hundredths = lambda part, up: F.expr(f"({part} * score + {up}) div 100")
    pending = near.where("score >= 0").select("anchor_id", "place", "score", hundredths(MOST, 0).alias("high"))
    pending, kept = pending.where(hundredths(LEAST, 99) <= F.col("high")), []
    for turn in TURNS:
        asks = pending.withColumn("least", hundredths(turn, 99)).groupBy(F.col("anchor_id").alias("vec_id"))
        asks = anchors.join(asks.agg(F.collect_list(F.struct("place", "least", "high")).alias("windows")), "vec_id")
        found = _first(_against(rows, asks, blocks, width, _negatives(negatives)), ["anchor_id", "place"], negatives)
        found = space.write(found, f"negatives-{turn}")
        if turn == TURNS[-1]:
            kept.append(found)
            break
        full = found.where(F.col("rank") == negatives).select("anchor_id", "place")
        kept.append(found.join(full, ["anchor_id", "place"], "left_semi"))
        pending = space.write(pending.join(full, ["anchor_id", "place"], "left_anti"), f"pending-{turn}")
        if pending.isEmpty():
            break
    chosen = reduce(DataFrame.unionByName, kept)
    names = near.select("anchor_id", "place", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(names, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
