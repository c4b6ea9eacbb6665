"""A keyed Parquet dataset with merge-on-read updates and optimistic commits.

Rows live in ``data/<folder>/bucket=<n>``. An update writes only its changed
rows, as deltas; ``compact`` joins them with the bucket's base. A commit is one
small JSON-lines file named by its version that comes into being as a whole or
not at all, so readers see all of an update or nothing of it: data without a
commit is never read. Of two writers of one version the second one looks at
what the first one did: it takes the next version if they touched different
buckets, else it starts anew. Every ``EVERY`` commits the live state is written
as Parquet, so a reader opens that and the few commits after it.

A commit holds a digest of the rows that a bucket got, so the same batch is
known again without a look at the stored rows. ``stats/<folder>`` holds ranges
of key and cursor and a bitmap of the keys for each file of a bucket, so a
search opens only what can hold the rows that it wants.
"""

import json
import uuid
from dataclasses import dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aftermath.operators import cursors, merging
from aftermath.operators.ranking import keep_first
from aftermath.session import TASK_ROWS, dealt, durable, task_rows
from aftermath.sources import statistics
from aftermath.sources.tables import path_exists, sizes

COMMIT_SCHEMA = (
    "version long, kind string, bucket int, folder string, source string, mark_time string, mark_key string, "
    "layout string, width int, stream string, batch long, report string, digest string, keys long, stale long"
)
# Commits between two written states, and deltas of a bucket that an update leaves before it compacts.
EVERY = 50
MOST_DELTAS = 8
# A batch with more keys a bucket meets every bitmap, so it is not compared with them.
FEW_KEYS = statistics.PARTS * statistics.BITS // 8
RETRIES = 20


class CommitConflict(RuntimeError):
    """Another writer committed to the same buckets."""


@dataclass(frozen=True)
class Snapshot:
    """Last version, column layout (None before the first commit), folders per bucket (base first, then deltas) and number of buckets.

    ``digests`` has, for the newest folder of a bucket, the digest of the rows
    that led to it, the number of their keys and how many of these were stale.
    ``keys`` has the most rows that the folders of a bucket hold.
    """

    version: int
    layout: T.StructType | None
    buckets: dict[int, tuple[str, ...]] = field(default_factory=dict)
    width: int | None = None
    digests: dict[int, tuple[str, int, int]] = field(default_factory=dict)
    keys: dict[int, int] = field(default_factory=dict)

    def rows(self, only: list[int] | None = None) -> int:
        """The most rows that some buckets hold."""
        return sum(n for b, n in self.keys.items() if only is None or b in only)


class CommitLog:
    """Versions with their files, sources, stream batches and high-water marks."""

    def __init__(self, spark: SparkSession, root: str, every: int = EVERY):
        self.spark, self.root, self.every = spark, root, every
        self.path, self.states = f"{root}/commits", f"{root}/states"

    def _file_system(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        target, system = self._file_system(path)
        return [status.getPath().getName() for status in system.listStatus(target)] if system.exists(target) else []

    def sources_of_state(self, at: int | None = None) -> tuple[int, list[str]]:
        """The version of the newest written state (0: none) and the commit files after it, up to version ``at``."""
        wanted = [int(n) for n in self._names(self.states) if n.isdigit() and (at is None or int(n) <= at)]
        last = next((n for n in sorted(wanted, reverse=True) if path_exists(self.spark, f"{self.states}/{n:020d}/_SUCCESS")), 0)
        names = sorted(n for n in self._names(self.path) if n.endswith(".json") and last < int(n[:-5]) <= (at or int(n[:-5])))
        return last, [f"{self.path}/{n}" for n in names]

    def rows(self, at: int | None = None) -> DataFrame:
        """The live entries: of the newest written state, and of the commits after it, up to version ``at``."""
        last, files = self.sources_of_state(at)
        parts = [self.spark.read.schema(COMMIT_SCHEMA).parquet(f"{self.states}/{last:020d}")] if last else []
        parts += [self.spark.read.schema(COMMIT_SCHEMA).json(files)] if files else []
        return merging.union_by_name(*parts) if parts else self.spark.createDataFrame([], COMMIT_SCHEMA)

    def snapshot(self, at: int | None = None) -> Snapshot:
        """The current state, or that of version ``at``, from one pass; the live files of each bucket and one more row are collected."""
        if at == 0:
            return Snapshot(0, None)
        rows = self.rows(at)
        last = F.struct("version", "layout", "width")
        known = ("digest", "keys", "stale")
        found = rows.where("kind IN ('base', 'delta')").select("version", "kind", "bucket", "folder", "layout", "width", *known)
        newest = rows.where("kind = 'commit'").agg(F.max(last).alias("m")).select(
            "m.version", F.lit("commit").alias("kind"), F.lit(-1).alias("bucket"), F.lit("").alias("folder"), "m.layout", "m.width",
            F.lit(None).alias("digest"), F.lit(None).alias("keys"), F.lit(None).alias("stale"),
        )
        entries = sorted(found.unionByName(newest).collect(), key=lambda r: (r.version or 0, r.kind))
        state = next(r for r in entries if r.kind == "commit")
        if state.version is None:
            return Snapshot(0, None)
        buckets: dict[int, tuple[str, ...]] = {}
        keys: dict[int, int] = {}
        for r in entries:
            if r.kind == "base":
                buckets[r.bucket] = (r.folder,)
                keys[r.bucket] = r.keys or 0
            elif r.kind == "delta":
                buckets[r.bucket] = (*buckets.get(r.bucket, ()), r.folder)
                keys[r.bucket] = keys.get(r.bucket, 0) + (r.keys or 0)
        digests = {r.bucket: (r.digest, r.keys, r.stale) for r in entries if r.kind != "commit"}
        return Snapshot(state.version, T.StructType.fromJson(json.loads(state.layout)), buckets, state.width, digests, keys)

    def sources(self) -> DataFrame:
        return self.rows().where("source IS NOT NULL").select("source").distinct()

    def report_of(self, stream: str, batch: int) -> dict | None:
        """What the commit of a stream's batch reported; None if there is none. The newest batch of a stream is kept."""
        row = self.rows().where((F.col("stream") == stream) & (F.col("batch") == batch)).select("report").head()
        return None if row is None else json.loads(row.report)

    def _create(self, path: str, text: str) -> bool:
        """Write a file as a whole unless it exists; whether this call made it."""
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        part, system = self._file_system(f"{self.root}/open/{uuid.uuid4().hex}")
        target = system.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
        system.mkdirs(target.getParent())
        stream = system.create(part, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
        kind = jvm.org.apache.hadoop.fs.Options.Rename
        options = gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            context.rename(system.makeQualified(part), target, options)
        except Py4JJavaError as error:
            system.delete(part, False)
            if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
                raise
            return False
        return True

    def append(self, seen: int, entry: dict, files: list[tuple] = ()) -> int:
        """Commit ``files`` (kind, bucket, folder, and what is known of its rows if anything), made from the state of version ``seen``; the version.

        ``CommitConflict`` if a commit after ``seen`` has one of the buckets, the
        source or the batch, or changed the columns.
        """
        version = seen + 1
        while True:
            lines = [{"version": version, "kind": "commit", **entry}]
            lines += [{"version": version, "kind": kind, "bucket": bucket, "folder": folder, **dict(*known)} for kind, bucket, folder, *known in files]
            if self._create(f"{self.path}/{version:020d}.json", "\n".join(map(json.dumps, lines)) + "\n"):
                break
            self._agree(version, entry, {bucket for _, bucket, *_ in files})
            version += 1
        if version % self.every == 0:
            self.write_state(version)
        return version

    def _agree(self, version: int, entry: dict, touched: set[int]) -> None:
        other = self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.path}/{version:020d}.json").collect()
        theirs = next(r for r in other if r.kind == "commit")
        same_batch = entry.get("stream") is not None and (theirs.stream, theirs.batch) == (entry["stream"], entry["batch"])
        same_source = entry.get("source") is not None and theirs.source == entry["source"]
        if touched & {r.bucket for r in other} or same_batch or same_source or theirs.layout != entry.get("layout"):
            raise CommitConflict(f"version {version} of {self.root} is another writer's")

    def _best_mark(self, rows: DataFrame, layout: T.StructType | None, cursor: str | None, key: str | None) -> DataFrame:
        typed = F.struct(F.col("mark_time").alias("t"), F.col("mark_key").alias("k"))
        if layout is not None and cursor in layout.names and key in layout.names:
            typed = F.struct(
                F.col("mark_time").try_cast(layout[cursor].dataType).alias("t"),
                F.col("mark_key").try_cast(layout[key].dataType).alias("k"),
            )
        return rows.where("mark_time IS NOT NULL").agg(F.max_by(F.struct("mark_time", "mark_key"), typed).alias("m"))

    def write_state(self, version: int) -> None:
        """Write what of the log is live. Writers of one state write the same, so a repeat changes nothing."""
        rows = self.rows().where(F.col("version") <= version)
        bases = rows.where("kind = 'base'").groupBy("bucket").agg(F.max("version").alias("_base"))
        files = rows.where("kind IN ('base', 'delta')").join(F.broadcast(bases), "bucket").where("version >= _base").drop("_base")
        last = rows.where("kind = 'commit'").agg(F.max_by(F.struct("*"), "version").alias("r")).select("r.*")
        marks = rows.where("mark_time IS NOT NULL").select("version", F.lit("mark").alias("kind"), "mark_time", "mark_key").distinct()
        named = rows.where("source IS NOT NULL").groupBy("source").agg(F.min("version").alias("version"))
        batches = rows.where("stream IS NOT NULL").groupBy("stream")
        batches = batches.agg(F.max_by(F.struct("version", "batch", "report"), "batch").alias("r"))
        live = merging.union_by_name(
            self.spark.createDataFrame([], COMMIT_SCHEMA),
            files,
            last.drop("source", "mark_time", "mark_key", "stream", "batch", "report"),
            self._newest_marks(marks),
            named.select("version", F.lit("source").alias("kind"), "source"),
            batches.select("r.version", F.lit("batch").alias("kind"), "stream", "r.batch", "r.report"),
        )
        live.coalesce(1).write.mode("overwrite").parquet(f"{self.states}/{version:020d}")

    @staticmethod
    def _newest_marks(marks: DataFrame) -> DataFrame:
        """Few marks that hold the highest one whatever its type: the highest as text and as numbers."""
        orders = {"text": F.struct("mark_time", "mark_key"), "number": F.struct("mark_time", F.col("mark_key").try_cast("double"))}
        orders["numbers"] = F.struct(F.col("mark_time").try_cast("double"), F.col("mark_key").try_cast("double"))
        orders["mixed"] = F.struct(F.col("mark_time").try_cast("double"), F.col("mark_key"))
        found = marks.agg(*(F.max_by(F.struct("version", "kind", "mark_time", "mark_key"), by).alias(name) for name, by in orders.items()))
        return found.select(F.explode(F.array(*orders)).alias("r")).where("r IS NOT NULL").select("r.*").distinct()


@dataclass
class KeyedStore:
    """One dataset with a unique key and a cursor that orders its versions.

    ``buckets`` is fixed at creation and recorded with each commit; choose it so
    that a bucket is a few hundred megabytes. An upsert with another number is
    an error, because keys would be looked for in the wrong buckets.
    """

    spark: SparkSession
    root: str
    key: str
    cursor: str
    buckets: int = 64

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.root)

    def bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn("bucket", F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.buckets)).cast("int"))

    def read(self) -> DataFrame | None:
        """The current rows; None before the first commit."""
        return self._at(self.log.snapshot())

    def _paths(self, state: Snapshot, only: list[int] | None = None) -> dict[int, list[str]]:
        wanted = state.buckets if only is None else {b: f for b, f in state.buckets.items() if b in only}
        return {bucket: [f"{self.root}/data/{folder}/bucket={bucket}" for folder in folders] for bucket, folders in wanted.items()}

    def _at(self, state: Snapshot, only: list[int] | None = None, opened: set[tuple[int, str]] | None = None) -> DataFrame | None:
        """The rows of some buckets: those of the base whose key no delta has, and of each such key the newest.

        A folder has a key once, so the only delta of a bucket is read as it is.
        ``opened`` names the (bucket, folder) to open; the others must not matter to the caller.
        """
        if state.layout is None:
            return None
        read = self.spark.read.schema(state.layout)
        plain, once, often = [], ([], []), ([], [])  # bases alone; bases and deltas of buckets with one, and with several deltas
        for bucket, folders in state.buckets.items():
            if only is not None and bucket not in only:
                continue
            base, *later = [f"{self.root}/data/{f}/bucket={bucket}" if opened is None or (bucket, f) in opened else None for f in folders]
            later = [path for path in later if path]
            bases, deltas = often if len(later) > 1 else once
            deltas += later
            if base:
                (bases if later else plain).append(base)
        parts = [read.parquet(*plain)] if plain else []
        for bases, deltas in (once, often):
            if not deltas:
                continue
            newest = read.parquet(*deltas)
            if deltas is often[1]:
                # the folder of a delta begins with a number that grows from one to the next
                newest = newest.withColumn("_folder", F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+)/", 1))
                newest = dealt(newest, [self.key], state.rows(only))
                newest = keep_first(newest, [self.key], [F.desc("_folder")]).drop("_folder").select(*state.layout.names)
            parts.append(newest)
            if bases:
                keys = dealt(newest, [self.key], state.rows(only)) if deltas is once[1] else newest
                parts.append(merging.new_rows(read.parquet(*bases), keys, [self.key]).select(*state.layout.names))
        return merging.union_by_name(*parts) if parts else self.spark.createDataFrame([], state.layout)

    def _statistics(self, state: Snapshot, only: list[int] | None = None) -> tuple[set[tuple[int, str]], DataFrame | None]:
        """The (bucket, folder) without statistics, and the statistics of the others."""
        live = {(b, f) for b, folders in state.buckets.items() if only is None or b in only for f in folders}
        written = set(self.log._names(f"{self.root}/stats"))
        known = sorted({f for _, f in live if f in written})
        if not known:
            return live, None
        found = statistics.read(self.spark, f"{self.root}/stats", known, state.layout, self.key, self.cursor)
        return {(b, f) for b, f in live if f not in written}, found

    def _sought(self, rows: DataFrame) -> DataFrame:
        """The bitmaps of the keys of ``rows``, with the number of rows of each."""
        keys = self.bucketed(rows.where(F.col(self.key).isNotNull()).select(self.key))
        return statistics.key_bitmaps(keys, self.key, F.count(F.lit(1)).alias("n"))

    def _holding(self, state: Snapshot, rows: DataFrame, only: list[int] | None = None) -> set[tuple[int, str]] | None:
        """The (bucket, folder) that may have a key of ``rows``: at most one per live file is collected."""
        return self._meeting(state, self._sought(rows), only)

    def _meeting(self, state: Snapshot, sought: DataFrame, only: list[int] | None = None) -> set[tuple[int, str]] | None:
        """What ``_holding`` gives, from the bitmaps of the keys."""
        opened, found = self._statistics(state, only)
        if found is None:
            return None
        return opened | {(r.bucket, r.folder) for r in statistics.meeting(found, sought).collect()}

    def _stored_keys(self, state: Snapshot, rows: DataFrame) -> DataFrame:
        """The distinct keys of the files that may have one of ``rows``, dealt out as both ask for."""
        sought = durable(self._sought(rows))
        stored = self._at(state, None, self._meeting(state, sought)).select(self.key)
        many = sought.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head().n + state.rows()
        return dealt(stored, [self.key], many).distinct()

    def known(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is stored. Opens the files whose key range and bitmap meet those of ``rows``."""
        state = self.log.snapshot()
        if state.layout is None:
            return rows.limit(0)
        return rows.join(self._stored_keys(state, rows), [self.key], "left_semi")

    def fresh(self, rows: DataFrame) -> DataFrame:
        """The rows whose key is not stored, null keys among them; opens what ``known`` does."""
        state = self.log.snapshot()
        if state.layout is None:
            return rows
        return rows.join(self._stored_keys(state, rows), [self.key], "left_anti")

    def rows_after(self, time, key) -> DataFrame | None:
        """The current rows after the mark (time, then key). Opens the files with a cursor of that time or later.

        A newer version of a row never has an earlier cursor, so a file that is
        left out replaces no row of the result.
        """
        state = self.log.snapshot()
        if state.layout is None:
            return None
        opened, found = self._statistics(state)
        if found is not None:
            opened |= {(r.bucket, r.folder) for r in statistics.reaching(found, time).collect()}
        return self._at(state, None, opened).where(cursors.after_mark(self.cursor, self.key, time, key))

    def changes(self, since: int) -> DataFrame | None:
        """Rows that differ between version ``since`` and now, with ``change``: ``after`` as they are, ``before`` as they were.

        A new row has no ``before``. Only the deltas written since are read, and
        old files that may hold their keys; a bucket compacted in between is
        compared in full. The files of ``since`` must not be discarded yet.
        None before the first commit.
        """
        old, now = self.log.snapshot(since), self.log.snapshot()
        if now.layout is None:
            return None
        added, replaced = {}, []
        for bucket, folders in now.buckets.items():
            had = old.buckets.get(bucket, ())
            if folders[: len(had)] != had:
                replaced.append(bucket)
            elif folders != had:
                added[bucket] = folders[len(had) :]
        shape = replace(old, layout=now.layout)  # columns only grow
        after = self._at(replace(now, buckets=added))
        if replaced:
            same = F.lit(True)
            for name in now.layout.names:
                same &= F.col(f"n.`{name}`").eqNullSafe(F.col(f"o.`{name}`"))
            whole = self._at(now, replaced).alias("n").join(self._at(shape, replaced).alias("o"), same, "left_anti")
            after = after.unionByName(whole)
        after = durable(after)
        touched = [*added, *replaced]
        before = merging.known_rows(self._at(shape, touched, self._holding(shape, after, touched)), after, [self.key])
        return after.withColumn("change", F.lit("after")).unionByName(before.withColumn("change", F.lit("before")))

    def stored_sizes(self) -> tuple[int, float]:
        """Files and megabytes that a read opens."""
        paths = [path for some in self._paths(self.log.snapshot()).values() for path in some]
        if not paths:
            return 0, 0.0
        row = sizes(self.spark.read.parquet(*paths)).head()
        return row.files, row.megabytes

    def mark(self) -> tuple[str, str] | None:
        """The highest (cursor, key) over all committed batches, as text."""
        layout = self.log.snapshot().layout
        if layout is None:
            return None
        row = self.log._best_mark(self.log.rows(), layout, self.cursor, self.key).head()
        return None if row.m is None else tuple(row.m)

    def _written(self, rows: DataFrame, version: int) -> str:
        """Write rows by bucket to a folder of their own; its name."""
        folder = f"{version:012d}-{uuid.uuid4().hex}"
        # Rebalancing groups rows by bucket, and splits a bucket too big for one task.
        written = self.bucketed(rows).hint("rebalance", "bucket").write.option("compression", "zstd")
        written.partitionBy("bucket").parquet(f"{self.root}/data/{folder}")
        stored = self.spark.read.schema(self.bucketed(rows).schema).parquet(f"{self.root}/data/{folder}")
        statistics.write(stored, f"{self.root}/stats/{folder}", self.key, self.cursor)
        return folder

    def compact(self, least: int = 1) -> int:
        """Join base and deltas of all buckets with ``least`` deltas or more, in one commit; their number.

        Rows stay the same. Buckets that another writer commits to meanwhile are left for the next call.
        """
        state = self.log.snapshot()
        wanted = sorted(b for b, folders in state.buckets.items() if len(folders) > least)
        if not wanted:
            return 0
        folder = self._written(self._at(state, wanted), state.version + 1)
        written = self.spark.read.schema(T.StructType([*state.layout, T.StructField("bucket", T.IntegerType())]))
        digested = written.parquet(f"{self.root}/data/{folder}").groupBy("bucket")
        digested = digested.agg(statistics.digest(state.layout).alias("digest"), F.count(F.lit(1)).alias("keys")).collect()
        known = {r.bucket: {"digest": r.digest, "keys": r.keys, "stale": 0} for r in digested}  # one row per bucket
        entry = {"layout": state.layout.json(), "width": state.width}
        try:
            self.log.append(state.version, entry, [("base", bucket, folder, known.get(bucket, {})) for bucket in wanted])
        except CommitConflict:
            return 0
        return len(wanted)

    def upsert(
        self, incoming: DataFrame, source: str | None = None, arrival: str | None = None, batch: tuple[str, int] | None = None
    ) -> dict:
        """Insert new keys, replace older versions, ignore identical and stale ones.

        Applying the same rows again changes nothing, so a batch may be retried
        after a failure at any point. ``batch`` (stream, number) names one that is
        applied once: a retry gives the counts of the first try. ``arrival`` names
        a column that decides between rows of equal cursor within the batch; it
        is not stored. If another writer commits to the same buckets, the batch
        is judged again against what that one left.
        """
        for _ in range(RETRIES):
            known = None if batch is None else self.log.report_of(*batch)
            if known is not None:
                return known
            try:
                return self._upsert(incoming, source, arrival, batch)
            except CommitConflict:
                continue
        raise CommitConflict(f"{RETRIES} attempts on {self.root} met other writers")

    def _upsert(self, incoming: DataFrame, source: str | None, arrival: str | None, batch: tuple[str, int] | None) -> dict:
        state = self.log.snapshot()
        if state.width not in (None, self.buckets):
            raise ValueError(f"{self.root} has {state.width} buckets, not {self.buckets}")
        sizes = self.bucketed(incoming).groupBy("bucket", F.col(self.key).isNull().alias("no_key"))
        counts = sizes.agg(F.count(F.lit(1)).alias("n"), statistics.digest(incoming.schema).alias("digest")).collect()  # at most two rows per bucket
        received = sum(r.n for r in counts if not r.no_key)
        digests = {r.bucket: r.digest for r in counts if not r.no_key}
        # The last rows that such a bucket got are the same, so its new and updated ones are stored and its stale ones still are stale.
        again = [b for b, d in digests.items() if d is not None and state.digests.get(b, (None,))[0] == d]
        wanted = [b for b in digests if b not in again]
        judged = self._judged(state, incoming, wanted, received, arrival) if wanted else None
        tally = [] if judged is None else self._tally(judged)
        kinds = (merging.NEW, merging.UPDATED, merging.UNCHANGED, merging.STALE)
        report = {
            "incoming": received,
            "without_key": sum(r.n for r in counts if r.no_key),
            **{kind: sum(r.n for r in tally if r.outcome == kind) for kind in kinds},
        }
        report[merging.UNCHANGED] += sum(state.digests[b][1] - state.digests[b][2] for b in again)
        report[merging.STALE] += sum(state.digests[b][2] for b in again)
        report["duplicates"] = received - sum(r.n for r in tally) - sum(state.digests[b][1] for b in again)
        touched = sorted({r.bucket for r in tally if r.outcome in (merging.NEW, merging.UPDATED)})
        report["buckets_rewritten"] = len(touched)
        top = max((r for r in tally if r.top.t is not None), key=lambda r: tuple(r.top), default=None)
        mark = (None, None) if top is None else (top.time, top.key)
        if touched or source is not None:
            layout, files = state.layout or incoming.drop(arrival or "").schema, []
            if touched:
                changed = judged.where(F.col("outcome").isin(merging.NEW, merging.UPDATED)).drop("outcome", "bucket")
                added = [f for f in changed.schema if f.name not in layout.names]
                layout = T.StructType([*layout, *added])
                folder = self._written(changed, state.version + 1)
                known = {b: {"digest": digests[b], "keys": 0, "stale": 0} for b in touched}
                for r in tally:
                    if r.bucket in known:
                        known[r.bucket]["keys"] += r.n
                        known[r.bucket]["stale"] += r.n if r.outcome == merging.STALE else 0
                files = [("delta" if bucket in state.buckets else "base", bucket, folder, known[bucket]) for bucket in touched]
            entry = {"source": source, "mark_time": mark[0], "mark_key": mark[1], "layout": layout.json(), "width": self.buckets}
            if batch is not None:
                entry |= {"stream": batch[0], "batch": batch[1], "report": json.dumps(report)}
            self.log.append(state.version, entry, files)
            if any(len(state.buckets.get(bucket, ())) > MOST_DELTAS for bucket in touched):
                self.compact(MOST_DELTAS)
        return report

    def _judged(self, state: Snapshot, incoming: DataFrame, wanted: list[int], received: int, arrival: str | None) -> DataFrame:
        """The newest rows of the keys of some buckets, with their bucket and outcome."""
        rows = self.bucketed(incoming.where(F.col(self.key).isNotNull())).where(F.col("bucket").isin(wanted)).drop("bucket")
        # one dealing-out serves the newest rows, the keys and the join with the stored rows
        rows = dealt(rows, [self.key], received + state.rows(wanted) if received > task_rows(rows, TASK_ROWS) else 0)
        if arrival is not None:
            rows = merging.keep_latest(rows, [self.key], self.cursor, [arrival]).drop(arrival)
        few = state.layout is not None and received <= FEW_KEYS * len(wanted)
        stored = self._at(state, wanted, self._holding(state, rows, wanted) if few else None)
        if stored is None:
            stored = self.spark.createDataFrame([], rows.schema)
        return durable(self.bucketed(merging.classify(stored, rows, [self.key], self.cursor, few)))

    def _tally(self, judged: DataFrame) -> list:
        """At most four rows per bucket: one for each outcome, with the number of keys and the highest (cursor, key)."""
        top = F.max(F.struct(F.col(self.cursor).alias("t"), F.col(self.key).alias("k"))).alias("top")
        return (
            judged.groupBy("bucket", "outcome")
            .agg(F.count(F.lit(1)).alias("n"), top)
            .select("*", F.col("top.t").cast("string").alias("time"), F.col("top.k").cast("string").alias("key"))
            .collect()
        )

    def discard_replaced(self) -> int:
        """Delete base and delta folders of buckets that no current read needs, and their statistics; the number of folders.

        Call it when nobody reads an older state or is writing.
        """
        current = {(folder, bucket) for bucket, folders in self.log.snapshot().buckets.items() for folder in folders}
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/*/bucket=*")
        system = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration())
        removed = 0
        for status in (system.globStatus(pattern) or []) if current else []:
            folder, bucket = status.getPath().toString().rsplit("/", 2)[1:]
            if (folder, int(bucket.split("=")[1])) not in current:
                removed += system.delete(status.getPath(), True)
        live = {folder for folder, _ in current}
        for name in self.log._names(f"{self.root}/stats") if current else []:
            if name not in live:
                system.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/stats/{name}"), True)
        return removed


def publish(df: DataFrame, root: str) -> int:
    """Replace a whole table: write a new version, then make it current. Of two writers the later commit stands."""
    log = CommitLog(df.sparkSession, root)
    folder = uuid.uuid4().hex
    df.write.option("compression", "gzip").parquet(f"{root}/data/{folder}")
    for _ in range(RETRIES):
        try:
            return log.append(log.snapshot().version, {"layout": df.schema.json()}, [("base", 0, folder)])
        except CommitConflict:
            continue
    raise CommitConflict(f"{RETRIES} attempts on {root} met other writers")


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """The current version of a table written by ``publish``; None if there is none."""
    state = CommitLog(spark, root).snapshot()
    if state.layout is None:
        return None
    return spark.read.schema(state.layout).parquet(f"{root}/data/{state.buckets[0][0]}")
