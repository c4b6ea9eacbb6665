"""Shared folders, distributed running totals and connected components."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

_LOCAL: dict[str, str] = {}

# The sizes of up to so many groups, three values each, are broadcast.
FEW_GROUPS = 10_000


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a local session without it gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _LOCAL.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="aftermath-llm-"))


class Workspace:
    """Written tables of one run, in a folder of their own under the shared root.

    A table that is read more than once is written, so a lost executor costs
    only the tasks it ran. ``drop`` removes a table that nothing reads any more;
    tables behind a returned DataFrame stay with the cluster's checkpoint files.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str, batch_bytes: int | None = None) -> DataFrame:
        """The written table; ``batch_bytes`` bounds the Arrow batches of its Python stages."""
        path, setting = f"{self.folder}/{name}", "spark.sql.execution.arrow.maxBytesPerBatch"
        before = self.spark.conf.get(setting)
        try:
            if batch_bytes:
                self.spark.conf.set(setting, str(batch_bytes))
            df.write.parquet(path)
        finally:
            self.spark.conf.set(setting, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unit(hashed: Column) -> Column:
    """A 64-bit hash as a double in (0, 1)."""
    return (F.shiftrightunsigned(hashed, 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def null_safe_key(column: Column) -> Column:
    """Text that tells null from every value: a join key that never is null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit("null"))


def running_totals(space: Workspace, df: DataFrame, group: str, draw: str, ties: list[str], value: str) -> DataFrame:
    """Add ``row_no`` (from 0), ``before`` (sum of ``value`` over earlier rows), ``rows`` and ``total`` of the group.

    Rows of a group are ordered by the 64-bit hash ``draw``, then ``ties``. The
    range of the hash is cut into as many pieces as a piece has rows, the square
    root of the group's size, so that neither the rows of a piece nor the sums
    of a group's pieces are many for the task that orders them.
    ``df`` is read three times: pass a written table. ``group`` and ``draw``
    must not be null. The sizes of few groups are broadcast, so that no row is
    shuffled by its group.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("rows"), F.sum(value).alias("total"))
    sizes = space.write(sizes, "sizes")
    sizes = F.broadcast(sizes) if sizes.count() <= FEW_GROUPS else sizes
    pieces = F.ceil(F.sqrt("rows"))
    cut = df.join(sizes, group).withColumn("_piece", F.floor(unit(F.col(draw)) * pieces))
    earlier = Window.partitionBy(group).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(group, "_piece")
        .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
        .select(
            group,
            "_piece",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_v").over(earlier), F.lit(0)).alias("_before"),
        )
    )
    inside = Window.partitionBy(group, "_piece").orderBy(F.shiftrightunsigned(draw, 1), draw, *ties)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    # The windows of a group's pieces would also be content with the rows dealt out by group.
    return (
        cut.repartition(group, "_piece")
        .join(offsets, [group, "_piece"])
        .withColumn("row_no", F.col("_rows_before") + F.row_number().over(inside) - 1)
        .withColumn("before", F.col("_before") + F.coalesce(F.sum(value).over(upto), F.lit(0)))
        .drop("_piece", "_rows_before", "_before")
    )


def components(space: Workspace, links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node reachable.

    Alternating large and small stars: each round sends every neighbour to the
    smallest one, by a grouped minimum and a join (both split by Spark if one
    node has very many links). Rounds end when the written links are stars, so
    links that are stars already take none; only that answer reaches the driver.
    """
    def smallest(both: DataFrame) -> DataFrame:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return both.join(least, "u")

    def stars(df: DataFrame) -> bool:
        """Every node has one smaller neighbour, which has none itself, or only larger ones."""
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return ends.where("up + down > 1 AND up > 0").agg(F.count(F.lit(1))).first()[0] == 0

    edges = space.write(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links-0")
    turn = 0
    while not stars(edges):
        turn += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = space.write(large.distinct(), f"large-{turn}")
        small = smallest(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
        edges = space.write(small.where("u > v").distinct(), f"links-{turn}")
        space.drop(f"large-{turn}", f"links-{turn - 1}")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
