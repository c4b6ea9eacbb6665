"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace
from aftermath.llm.words import PUNCTUATION, WHITESPACE, chunks, column_bytes, mixed, word_table, words_of

TABLE = word_table(WHITESPACE + PUNCTUATION, lower=True)
THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows fitted; everything else is the usual FTRL notation."""

    bits: int = 20
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 1.0
    skips: int = 1
    sample: int = 20_000
    shards: int = 6
    rounds: int = 3


def features(texts: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Text number and table index of every word, bigram and skip-gram."""
    hashes, first = words_of(texts, TABLE)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    owners, found = [owner], [hashes]
    for gap in range(1, settings.skips + 2):
        if len(hashes) > gap:
            same = owner[:-gap] == owner[gap:]
            pair = hashes[:-gap] * np.uint64(2 * gap + 1) + mixed(hashes[gap:])
            owners.append(owner[:-gap][same])
            found.append(mixed(pair[same]))
    index = np.concatenate(found) & np.uint64((1 << settings.bits) - 1)
    # place 0 is the bias, which every text has
    return np.concatenate(owners), np.maximum(index, np.uint64(1)).astype(np.int64)


def weights_of(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """The weights that FTRL-proximal's sums stand for: zero where |z| is within L1; the bias has no L1."""
    l1 = np.full(z.shape, s.l1)
    l1[0] = 0
    shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
    return -shrunk / ((s.beta + np.sqrt(n)) / s.alpha + s.l2)


def learn(texts: list[bytes], labels: list[int], z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass over the rows, one row at a time; ``z`` and ``n`` change in place."""
    for a, b in chunks(texts):
        owner, index = features(texts[a:b], s)
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(b - a + 1))
        for k in range(b - a):
            x = np.unique(index[order[cuts[k] : cuts[k + 1]]])
            x = np.concatenate(([0], x))
            zx, nx = z[x], n[x]
            l1 = np.full(len(x), s.l1)
            l1[0] = 0
            w = -np.sign(zx) * np.maximum(np.abs(zx) - l1, 0) / ((s.beta + np.sqrt(nx)) / s.alpha + s.l2)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[a + k]
            sigma = (np.sqrt(nx + g * g) - np.sqrt(nx)) / s.alpha
            z[x] = zx + g - sigma * w
            n[x] = nx + g * g


def held_out(doc_id) -> F.Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """(shard, text, y): at most ``s.sample`` labelled documents that are not held out, by a hash of the id.

    Rows of ``labels`` without id or label are left out; of repeated ones the larger label counts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    drawn = known.withColumn("draw", F.xxhash64("doc_id")).orderBy("draw", "doc_id").limit(s.sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most s.sample rows of two numbers are broadcast
    rows = texts.join(F.broadcast(drawn), "doc_id")
    return rows.select(F.pmod("draw", F.lit(s.shards)).cast("int").alias("shard"), "draw", "doc_id", "text", "y")


def _pass_from(start, s: Settings):
    """One shard's pass from the broadcast sums ``start``; gives the places it changed."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", "doc_id"], kind="stable")
        z0, n0 = (x.astype(np.float64) for x in start.value)
        z, n = z0.copy(), n0.copy()
        learn([(t or "").encode() for t in pdf.text], pdf.y.tolist(), z, n, s)
        at = np.flatnonzero((z != z0) | (n != n0))
        return pd.DataFrame({"place": at, "dz": z[at] - z0[at], "dn": n[at] - n0[at]})

    return run


def fit(space: Workspace, docs: DataFrame, labels: DataFrame, s: Settings) -> np.ndarray | None:
    """Weights of all table places, or None without labelled rows.

    Each round every shard starts from the same sums and makes one FTRL pass
    over its rows; Spark averages the changed places of all shards. Only the
    non-zero sums of the hash table, whose size is fixed, reach the driver.
    """
    rows = space.write(training_rows(docs, labels, s).repartition(s.shards, "shard"), "sample")
    shards = max(1, rows.select("shard").distinct().count())
    size = 1 << s.bits
    z, n = np.zeros(size), np.zeros(size)
    context = docs.sparkSession.sparkContext
    seen = 0
    for _ in range(s.rounds):
        start = context.broadcast((z.astype(np.float32), n.astype(np.float32)))
        changes = rows.groupBy("shard").applyInPandas(_pass_from(start, s), "place long, dz double, dn double")
        mean = changes.groupBy("place").agg((F.sum("dz") / shards).alias("dz"), (F.sum("dn") / shards).alias("dn"))
        got = mean.orderBy("place").toArrow()
        at = got["place"].to_numpy()
        z[at] += got["dz"].to_numpy()
        n[at] += got["dn"].to_numpy()
        seen += len(at)
        start.unpersist()
    space.drop("sample")
    return weights_of(z, n, s) if seen else None


def scored(docs: DataFrame, weights: np.ndarray | None, s: Settings) -> DataFrame:
    """(doc_id, score) of every row, whole text; a feature counts once in a text."""
    at = np.zeros(0, np.int64) if weights is None else np.flatnonzero(weights)
    compact = docs.sparkSession.sparkContext.broadcast((at, np.zeros(0) if weights is None else weights[at], weights is None))

    def run(batches):
        places, values, unknown = compact.value
        dense = np.zeros(1 << s.bits)
        dense[places] = values
        for batch in batches:
            texts = column_bytes(batch.column(1))
            score = np.zeros(len(texts))
            for a, b in chunks(texts) if not unknown else ():
                owner, index = features(texts[a:b], s)
                hit = dense[index] != 0
                both = np.unique(owner[hit] * np.int64(1 << s.bits) + index[hit])
                total = np.full(b - a, dense[0])
                np.add.at(total, both >> s.bits, dense[both & ((1 << s.bits) - 1)])
                score[a:b] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Null and empty texts get the bias alone. Repeated rows and equal texts get
    equal scores. Without any labelled row nothing is known and every score is
    0. ``labels`` is (doc_id, toxic); other columns of both are ignored. Rows
    with a null doc_id are scored and count as not held out.
    """
    space = Workspace(docs.sparkSession, "toxicity")
    found = scored(docs, fit(space, docs, labels, settings), settings)
    return found.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
