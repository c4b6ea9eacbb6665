"""The incremental ingest job: stage pages, merge them once, keep the mark."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aftermath.operators.merging import with_arrival
from aftermath.sources.store import KeyedStore
from aftermath.sources.tables import path_exists
from aftermath.spec import DatasetSpec, conform


def store_of(spark: SparkSession, root: str, spec: DatasetSpec, buckets: int = 64) -> KeyedStore:
    return KeyedStore(spark, f"{root}/raw/{spec.name}", spec.key, spec.cursor, buckets)


def stage(df: DataFrame, root: str, spec: DatasetSpec, run: str, page: int) -> None:
    """Write one page of a run; writing the same page again replaces it."""
    folder = f"{root}/staging/{spec.name}/run={run}/page={page}"
    conform(df, spec).write.mode("overwrite").parquet(folder)


def merge_staged(spark: SparkSession, root: str, spec: DatasetSpec, buckets: int = 64) -> list[dict]:
    """Merge the staged runs that no commit names yet, oldest first.

    The commit of the data also records the run and the mark, over all staged
    rows of the run, so a crash repeats a merge but neither loses rows nor
    advances the mark past them.
    """
    folder = f"{root}/staging/{spec.name}"
    if not path_exists(spark, folder):
        return []
    store = store_of(spark, root, spec, buckets)
    layout = T.StructType([*spec.schema, T.StructField("run", T.StringType()), T.StructField("page", T.IntegerType())])
    staged = spark.read.schema(layout).parquet(folder)
    pending = (
        staged.select(F.col("run").alias("source")).distinct().join(store.log.sources(), "source", "left_anti")
    )
    reports = []
    # One entry per ingest run, not per row.
    for row in pending.orderBy("source").collect():
        rows = with_arrival(staged.where(F.col("run") == row.source), F.col("page")).drop("run", "page")
        reports.append({"dataset": spec.name, "run": row.source, **store.upsert(rows, row.source, "_arrival")})
    return reports


def discard_merged(spark: SparkSession, root: str, spec: DatasetSpec) -> list[str]:
    """Delete the staged runs that a commit names, and give their names."""
    removed = []
    for row in store_of(spark, root, spec).log.sources().orderBy("source").collect():  # one entry per ingest run
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/staging/{spec.name}/run={row.source}")
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True):
            removed.append(row.source)
    return removed


def statistics(spark: SparkSession, root: str, spec: DatasetSpec) -> dict:
    """Existence, rows, size, key, cursor and mark of a stored dataset."""
    store = store_of(spark, root, spec)
    current = store.read()
    files, megabytes = store.stored_sizes()
    return {
        "dataset": spec.name,
        "exists": current is not None,
        "rows": 0 if current is None else current.count(),
        "files": files,
        "file_size_mb": megabytes,
        "key_field": spec.key,
        "checkpoint_field": spec.cursor,
        "mark": store.mark(),
        "path": store.root,
    }
