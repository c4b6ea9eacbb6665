"""Exact repeated strings of 200 bytes: content-chosen positions (minimizers) named by hashes.

This stands in for prefix doubling: nothing is sorted and no offset doubles. A
rank is a 64-bit hash of the string at a position; equal ranks mean equal
strings, but for collisions. Plain doubling keeps a row for every byte in every round. Here each window of
200 bytes is named by one position in it, the leftmost 40-byte string of least
hash: equal windows choose the same string at the same offset. Only those
positions get rows, about one in eighty bytes. Ranks grow from 40 bytes to
rank triples of 160 + 40 + 160 around the position, to 185 and 215 bytes for
each group of 16 windows, and to 200 for single windows; what is unique or past
the threshold leaves before each round.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace
from aftermath.llm.words import each_bytes, each_struct, hash_between, mixed, powers, prefix_hashes

LENGTH = 200  # bytes of a repeated string
SEED = 40  # bytes of the first rank
SPAN = LENGTH - SEED + 1  # seeds in a window; less than 256
AROUND = LENGTH - SEED
GROUP = 16  # windows decided together
SIEVE_BITS = 27  # of a bitmap that is broadcast: 16 MB, whatever the input
SLICE = 1 << 18  # bytes of a text that are hashed at once, beside what surrounds them
BATCH_BYTES = 16 << 20  # of whole texts in a task's batch


def chosen(h: np.ndarray) -> np.ndarray:
    """For each run of ``SPAN`` hashes the place of its least one, the leftmost of equals."""
    n = len(h) - SPAN + 1
    blocks = -(-len(h) // SPAN) + 1
    coded = np.full(blocks * SPAN, np.iinfo(np.uint64).max, np.uint64)
    coded[: len(h)] = h & ~np.uint64(255)
    coded = coded.reshape(blocks, SPAN) | np.arange(SPAN, dtype=np.uint64)
    ahead = np.minimum.accumulate(coded, axis=1).ravel()
    behind = np.minimum.accumulate(coded[:, ::-1], axis=1)[:, ::-1].ravel()
    left, right = behind[:n], ahead[SPAN - 1 : SPAN - 1 + n]
    low = np.uint64(255)
    block = np.arange(n) // SPAN * SPAN
    later = (np.arange(n) + SPAN - 1) // SPAN * SPAN
    take = (right & ~low) < (left & ~low)
    return np.where(take, later + (right & low).astype(np.int64), block + (left & low).astype(np.int64))


def anchors(text: bytes) -> list[np.ndarray]:
    """(place, first window, last window, rank, rank before, rank after) of all places that name windows.

    The text is taken in slices of windows, each with the bytes around it that
    its ranks need; a place that names windows of two slices is one place.
    """
    n, out = len(text), []
    for begin in range(0, n - LENGTH + 1, SLICE):
        end = min(begin + SLICE, n - LENGTH + 1)  # windows from begin to before end
        base = max(begin - AROUND, 0)
        part = np.frombuffer(text, np.uint8, min(end - 1 + LENGTH + AROUND, n) - base, base)
        sums = prefix_hashes(part)
        at = begin - base
        h = mixed((sums[at + SEED : end - 1 + LENGTH - base + 1] - sums[at : end - base + SPAN - 1]) * powers("down", len(sums))[at : end - base + SPAN - 1])
        best = chosen(h)
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        last = np.r_[first[1:], len(best)] - 1
        x = best[first] + at
        left, right = np.maximum(x - AROUND, 0), np.minimum(x + SEED + AROUND, len(part))
        before = hash_between(sums, left, x) + mixed((x - left).astype(np.uint64))
        after = hash_between(sums, x + SEED, right) + mixed((right - x).astype(np.uint64))
        found = [x + base, first + begin, last + begin, h[x - at], before, after]
        if out and out[-1][0][-1] == found[0][0]:
            out[-1][2][-1] = found[2][0]
            found = [c[1:] for c in found]
        if len(found[0]):
            out.append(found)
    return [np.concatenate(c) for c in zip(*out)]


def slices(text: bytes, places: np.ndarray, reach: int):
    """For each slice of a text that holds some of ``places``: which, its bytes with ``reach`` around, and where these begin."""
    order = np.argsort(places, kind="stable")
    cuts = np.flatnonzero(np.diff(places[order] // SLICE)) + 1
    for some in np.split(order, cuts):
        if len(some):
            base = max(int(places[some].min()) - reach, 0)
            end = min(int(places[some].max()) + reach, len(text))
            yield some, np.frombuffer(text, np.uint8, end - base, base), base


def _places(values: np.ndarray) -> np.ndarray:
    return (mixed(values.view(np.uint64)) >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)


def sieve(values: DataFrame):
    """A broadcast bitmap of a column of longs: most rows without a match stop before the shuffle.

    The join after it is exact. The size is fixed; where the bitmap fills up at
    a larger input, it lets more rows pass.
    """

    def run(batches):
        for batch in batches:
            places = np.unique(_places(batch.column(0).to_numpy()))
            words, first = np.unique(places >> 6, return_index=True)
            bits = np.bitwise_or.reduceat(np.int64(1) << (places & 63), first) if len(words) else words
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits)], ["word", "bits"])

    got = values.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (SIEVE_BITS - 6), np.int64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy()
    return values.sparkSession.sparkContext.broadcast(bits)


def passing(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    places = _places(values)
    return (bits[places >> 6] >> (places & 63)) & 1 == 1


def sifted(df: DataFrame, key: str, sieve, keep: bool = True) -> DataFrame:
    """The rows whose ``key`` passes the sieve, or those that do not."""
    at = df.columns.index(key)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(passing(sieve.value, batch.column(at).to_numpy()) == keep))

    return df.mapInArrow(run, df.schema)


def _positions(names_only: bool, sieve=None):
    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), each_bytes(batch.column(1))):
                if len(text) < LENGTH:
                    continue
                found = anchors(text)
                if sieve is not None:
                    alive = passing(sieve.value, found[3])
                    found = [column[alive] for column in found]
                x, first, last, name, before, after = found
                yield (name,) if names_only else (np.full(len(x), key, np.int64), x, first, last, name, before, after)

    return gathered(run, ["name"] if names_only else ["key", "x", "lo", "hi", "name", "before", "after"])


def gathered(run, names: list[str], rows: int = 50_000):
    """The columns that ``run`` yields, put together in batches of about ``rows``; masked values are null."""

    def merged(held):
        columns = [np.ma.concatenate(c) if np.ma.isMaskedArray(c[0]) else np.concatenate(c) for c in zip(*held)]
        arrays = [pa.array(np.ma.getdata(c).view(np.int64), mask=np.ma.getmaskarray(c) if np.ma.isMaskedArray(c) else None) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names)

    def batches_of(batches):
        held, n = [], 0
        for out in run(batches):
            held.append(out)
            n += len(out[0])
            if n >= rows:
                yield merged(held)
                held, n = [], 0
        if n:
            yield merged(held)

    return batches_of


def spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first, first + 1, ... n times, for each."""
    return np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _groups(batches):
    """Groups of windows at the same offsets from their name: (name, group, rank of all they share, of all they cover, key, lo, hi)."""
    for batch in batches:
        for key, text, asks in zip(batch.column(0).to_pylist(), each_bytes(batch.column(1)), each_struct(batch.column(2))):
            columns = [asks[c].astype(np.int64) for c in ("name", "x", "lo", "hi")]
            for some, part, base in slices(text, columns[1], 2 * LENGTH):
                sums = prefix_hashes(part)
                name, x, lo, hi = (c[some] for c in columns)
                least, most = (x - hi) // GROUP, (x - lo) // GROUP
                n = most - least + 1
                group = spread(least, n)
                name, x, lo, hi = (np.repeat(c, n) for c in (name, x, lo, hi))
                last = x - group * GROUP  # the group's last window and, before it, its first
                first = last - GROUP + 1
                shared = hash_between(sums, last - base, first + LENGTH - base)
                inside = (first >= 0) & (last + LENGTH <= len(text))
                covered = hash_between(sums, np.where(inside, first - base, 0), np.where(inside, last + LENGTH - base, 0))
                covered = np.ma.masked_array(covered.view(np.int64), ~inside)
                yield name, group, shared, covered, np.full(len(x), key, np.int64), np.maximum(lo, first), np.minimum(hi, last)


def _windows(batches):
    """Each asked window of a text: (name, rank of the whole window, key, place)."""
    for batch in batches:
        for key, text, asks in zip(batch.column(0).to_pylist(), each_bytes(batch.column(1)), each_struct(batch.column(2))):
            lo = asks["lo"].astype(np.int64)
            n = asks["hi"] - lo + 1
            places, names = spread(lo, n), np.repeat(asks["name"], n)
            for some, part, base in slices(text, places, LENGTH):
                p = places[some]
                whole = hash_between(prefix_hashes(part), p - base, p + LENGTH - base)
                yield names[some], whole, np.full(len(p), key, np.int64), p


def spans_of(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte runs that the windows starting from lo to hi cover."""
    if not len(lo):
        return []
    order = np.argsort(lo, kind="stable")
    start, reach = lo[order].astype(np.int64), np.maximum.accumulate(hi[order].astype(np.int64)) + LENGTH
    first = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
    return list(zip(start[first].tolist(), reach[np.r_[first[1:] - 1, len(reach) - 1]].tolist()))


def _cut(batches):
    for batch in batches:
        rows = []
        for text, windows in zip(each_bytes(batch.column(1)), each_struct(batch.column(2))):
            spans = spans_of(windows["lo"], windows["hi"])
            kept, at = hashlib.sha256(), 0
            for a, b in spans:
                kept.update(text[at:a])
                at = b
            kept.update(text[at:])
            rows.append((len(text), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"a": a, "b": b} for a, b in spans]))
        n_bytes, removed, n_spans, kept, spans = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()),
                pa.array(kept, pa.string()), pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
        )


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row of ``docs`` (doc_id, text).

    A byte goes if a 200-byte string over it starts anywhere else too, in the
    same text or another. Null and empty texts, and those under 200 bytes, stay
    whole. Repeated rows are documents of their own: they remove each other.
    A null id is an id. Other columns are ignored. Strings are equal if their
    128 bits of rank are. A text is held whole in its task, its ranks slice by
    slice. An empty table gives no rows.
    """
    space = Workspace(docs.sparkSession, "suffixes")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("doc_id", "text"))
    source = texts.where(F.octet_length("text") >= LENGTH).select("key", "text")

    # Round 1: 40 bytes. Names that occur once leave.
    names = source.mapInArrow(_positions(True), "name long").groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    names = space.write(names.where("_n > 1").select("name"), "names", BATCH_BYTES)
    schema = "key long, x long, lo long, hi long, name long, before long, after long"
    known = sieve(names)
    rows = source.mapInArrow(_positions(False, known), schema)
    rows = rows.withColumns({c: F.col(c).cast("int") for c in ("x", "lo", "hi")})
    rows = space.write(rows.join(names, "name"), "positions", BATCH_BYTES)
    known.unpersist()

    # Round 2: 360 bytes around. All windows of a place whose surroundings occur twice are repeated.
    around = rows.groupBy("name", "before", "after").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "x", "lo", "hi")).alias("one")
    )
    around = space.write(around, "around")
    twice = rows.join(around.where("n > 1").select("name", "before", "after"), ["name", "before", "after"], "left_semi")
    sure = space.write(twice.select("key", "lo", "hi"), "sure")
    several = around.groupBy("name").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("name")
    asks = around.join(several, "name").select("one.key", F.struct("name", "one.x", "one.lo", "one.hi").alias("ask"))
    asks = space.write(asks.groupBy("key").agg(F.collect_list("ask").alias("asks")), "asks")
    space.drop("names", "positions")

    # Round 3: groups of windows of names with several surroundings; one place speaks for each of these.
    # What the windows of a group share is in all of them, what they cover holds all of them.
    known = sieve(asks.select("key"))
    asked = sifted(source, "key", known).join(asks, "key").select("key", "text", "asks")
    asked = space.write(asked, "asked", BATCH_BYTES)
    known.unpersist()
    schema = "name long, grp long, shared long, covered long, key long, lo long, hi long"
    groups = asked.mapInArrow(gathered(_groups, [c.split()[0] for c in schema.split(", ")]), schema)
    groups = space.write(groups.withColumns({c: F.col(c).cast("int") for c in ("grp", "lo", "hi")}), "groups", BATCH_BYTES)

    def repeated(df: DataFrame, rank: str) -> DataFrame:
        """The (name, grp, rank) that occur twice."""
        found = df.where(F.col(rank).isNotNull()).groupBy("name", "grp", rank).agg(F.count(F.lit(1)).alias("_n"))
        return found.where("_n > 1").drop("_n")

    alive = groups.join(repeated(groups, "shared"), ["name", "grp", "shared"], "left_semi")
    full = repeated(groups, "covered").withColumn("_full", F.lit(True))
    alive = space.write(alive.join(full, ["name", "grp", "covered"], "left"), "alive")
    space.drop("around", "asks", "groups")

    # Round 4: single windows of the groups that are neither unique nor repeated as a whole.
    # One group of those repeated as a whole still has to speak for them where another may share some windows.
    undecided = alive.where("_full IS NULL")
    speakers = alive.where("_full").groupBy("name", "grp", "shared", "covered").agg(F.min(F.struct("key", "lo", "hi")).alias("one"))
    speakers = speakers.join(undecided.select("name", "grp", "shared").distinct(), ["name", "grp", "shared"], "left_semi")
    asks = undecided.select("key", "name", "lo", "hi").unionByName(speakers.select("one.key", "name", "one.lo", "one.hi"))
    asks = asks.groupBy("key").agg(F.collect_list(F.struct("name", "lo", "hi")).alias("asks"))
    windows = asked.select("key", "text").join(asks, "key").select("key", "text", "asks")
    windows = windows.mapInArrow(gathered(_windows, ["name", "whole", "key", "p"]), "name long, whole long, key long, p long")
    windows = space.write(windows.select("name", "whole", "key", F.col("p").cast("int").alias("p")), "windows", BATCH_BYTES)
    again = windows.groupBy("name", "whole").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("name", "whole")
    found = windows.join(again, ["name", "whole"]).select("key", F.col("p").alias("lo"), F.col("p").alias("hi"))
    found = found.unionByName(sure).unionByName(alive.where("_full").select("key", "lo", "hi"))
    found = space.write(found.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("windows")), "found")
    space.drop("sure", "asked", "alive", "windows")

    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<a:long,b:long>>"
    )
    cut = sieve(found.select("key"))
    touched = sifted(texts, "key", cut).join(found, "key", "left").select("doc_id", "text", "windows")
    none = F.lit(None).cast(found.schema["windows"].dataType).alias("windows")
    whole = sifted(texts, "key", cut, keep=False).select("doc_id", "text", none)
    result = space.write(touched.unionByName(whole).mapInArrow(_cut, schema), "result", BATCH_BYTES)
    cut.unpersist()
    space.drop("found")
    return result
