"""Session settings and durable materialisation."""

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# A join side of up to this many bytes is broadcast; a larger one is joined by shuffle.
BROADCAST_BYTES = 16 << 20
# Rows that a task sorts or groups where many rows are dealt out by key, and how many values of eight bytes
# they may have; a text counts as three. Of wider rows a task takes fewer.
TASK_ROWS = 1 << 19
TASK_VALUES = 12

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def open_session(app: str = "aftermath", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session with the settings the operators expect."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def task_rows(df: DataFrame, most: int) -> int:
    """How many rows of ``df`` a task sorts or groups: ``most``, or fewer if they are wide."""
    short = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")
    values = sum(1 if kind in short else 3 for _, kind in df.dtypes)
    return max(1, most * TASK_VALUES // max(values, TASK_VALUES))


def dealt(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` dealt out by key over as many tasks as ``rows`` of its width ask for, if one does not do.

    A fixed number of partitions gives each task more rows the larger the table
    is, and so does the size of compressed rows, which says little of rows that
    are alike. A join or grouping by the same keys follows this number on all its sides.
    """
    parts = -(-rows // task_rows(df, TASK_ROWS))
    return df if parts <= 1 else df.repartition(parts, *keys)


def shared_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting gets a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="aftermath-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there."""
    shared_root(df.sparkSession)
    return df.checkpoint()


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: the lengths of text and binary columns, and eight for each of the others."""
    long = [c for c, kind in df.dtypes if kind in ("string", "binary")]
    fixed = 8 + sum(16 if kind in ("string", "binary") else 8 for _, kind in df.dtypes)
    texts = [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in long]
    row = sum(texts, F.lit(fixed).cast("long"))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Materialise a join side of text and number columns and broadcast it if its size allows.

    Runs a job when called. Measuring the written rows is cheap. A side that is
    too large is returned without the hint, so that the join shuffles and AQE
    can split hot keys.
    """
    written = durable(df)
    return F.broadcast(written) if measured_bytes(written) <= most else written
