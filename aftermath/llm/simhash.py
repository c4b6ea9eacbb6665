"""SimHash near-duplicates: pigeonring candidates, Hamming check, components."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from aftermath.llm.shared import Workspace, components
from aftermath.llm.words import column_bytes

SEGMENTS, BITS = 8, 8
DISTANCE = 3
# Of n segments from a start, together, so many bits may differ: floor(n * 3 / 8).
BUDGETS = tuple(n * DISTANCE // SEGMENTS for n in range(1, SEGMENTS + 1))
# Five segments may differ in one bit, and the first two in none: two of the other three are equal.
AGREEING = ((0, 1, 2, 3), (0, 1, 2, 4), (0, 1, 3, 4))


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority of each bit over XXH64 of all word shingles; without words zero."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    span = min(shingle, len(words)) - 1
    cuts = zip(starts[: len(words) - span].tolist(), ends[span:].tolist())
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], seed) for a, b in cuts], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint's 64 bits as a signed long."""

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(t, shingle, seed) for t in column_bytes(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def _segment(fp: Column, start: int, n: int) -> Column:
    return F.shiftrightunsigned(fp, BITS * ((start + n) % SEGMENTS)).bitwiseAND(F.lit((1 << BITS) - 1))


def chain_keys(fp: Column) -> Column:
    """The 24 keys of a fingerprint: 8 chain starts, 3 choices of agreeing segments."""
    keys = []
    for start in range(SEGMENTS):
        for choice in AGREEING:
            key = F.lit(0).cast("long")
            for n in choice:
                key = F.shiftleft(key, BITS).bitwiseOR(_segment(fp, start, n))
            keys.append(F.struct(F.lit(start).alias("start"), F.lit(AGREEING.index(choice)).alias("choice"), key.alias("key")))
    return F.array(*keys)


def close_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of different values of ``fp`` at 3 or fewer differing bits.

    If at most 3 of 64 bits differ, some chain of the eight segments has every
    prefix within its proportional budget. Then two of its first two and two of
    the next three segments agree: a 32-bit equality key. The chain's other
    budgets and the whole distance are checked inside the join. Copies have one
    fingerprint, so they add no pairs.
    """
    keyed = nodes.select("fp", F.explode(chain_keys(F.col("fp"))).alias("k")).select("fp", "k.*")
    left = keyed.select(F.col("fp").alias("a"), F.col("start").alias("_s"), "choice", "key")
    right = keyed.select(F.col("fp").alias("b"), F.col("start").alias("_t"), F.col("choice").alias("_c"), F.col("key").alias("_k"))
    masks = []
    for n, budget in enumerate(BUDGETS, 1):
        if n == SEGMENTS or BUDGETS[n] != budget:  # else the longer chain has the same budget
            mask = -1 if n == SEGMENTS else (1 << (BITS * n)) - 1
            turned = f"(shiftrightunsigned(a ^ b, _s * {BITS}) | if(_s = 0, 0L, shiftleft(a ^ b, 64 - _s * {BITS})))"
            masks.append(f"bit_count({turned} & {mask}L) <= {budget}")
    condition = F.expr(f"a < b AND _s = _t AND choice = _c AND key = _k AND {' AND '.join(masks)}")
    return left.join(right, condition).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    Null and empty texts, and texts of blanks, have fingerprint zero and link
    like any other. Repeated rows and equal texts share a fingerprint and so a
    component. A null doc_id never names a component unless it is alone in it.
    Other columns are ignored.
    """
    space = Workspace(docs.sparkSession, "simhash")
    marked = space.write(fingerprints(docs, shingle, seed), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    links = space.write(close_pairs(nodes), "pairs")
    roots = space.write(components(space, links), "roots")
    grouped = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    grouped = space.write(grouped, "nodes")
    least = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = space.write(grouped.join(least, "root").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
