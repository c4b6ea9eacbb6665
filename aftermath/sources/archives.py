"""Readers of the two weather archives."""

import logging
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from aftermath.functions.text import numeric
from aftermath.session import shared_root

logger = logging.getLogger(__name__)

# Files that are landed at a time.
AT_ONCE = 16

# File-name pattern (year, version), columns used, and field positions.
STORM_FILE = r"StormEvents_details-ftp_v1\.0_d(\d{4})_c(\d+)\.csv\.gz"
STORM_COLUMNS = (
    "STATE_FIPS",
    "CZ_TYPE",
    "CZ_FIPS",
    "BEGIN_DATE_TIME",
    "END_DATE_TIME",
    "EVENT_TYPE",
    "MAGNITUDE",
    "MAGNITUDE_TYPE",
)
READING_SCHEMA = (
    "ID string, DATE string, ELEMENT string, VALUE long, MFLAG string, QFLAG string, SFLAG string, OBSTIME string"
)
# Zero-based half-open spans.
STATION_FIELDS = {
    "ID": (0, 11),
    "LATITUDE": (12, 20),
    "LONGITUDE": (21, 30),
    "ELEVATION": (31, 37),
    "STATE": (38, 40),
    "NAME": (41, 71),
}
STATION_NUMBERS = ("LATITUDE", "LONGITUDE", "ELEVATION")


def _land(spark: SparkSession, path: str, target: str) -> str | None:
    """Write the columns in use of one file to ``target``; the reason if it cannot be read to its end."""
    try:
        raw = spark.read.options(header=True, multiLine=True, escape='"', ignoreCorruptFiles=False).csv(path)
        found = {name.strip().upper(): name for name in raw.columns}
        if not found:
            return "no header"
        columns = [(F.col(f"`{found[c]}`") if c in found else F.lit(None)).cast("string").alias(c) for c in STORM_COLUMNS]
        raw.select(*columns).write.parquet(target)
    except Exception as error:  # the reader's errors and those of Java come as different classes
        return str(error).splitlines()[0]
    return None


def read_storm_files(spark: SparkSession, paths: Sequence[str], rejects: str | None = None) -> DataFrame:
    """Yearly CSV files with header, reduced to the columns in use.

    Files of different years may order or lack columns, so each is read by its
    own header and united by name. Each file is read once, when this is called,
    and its rows are written to the shared folder as Parquet, which later tasks
    split where they could not split the archive. There is one file per year,
    and one task can read it, so one small job per file, ``AT_ONCE`` together,
    is as wide as one job over all. A file without a header, or one that cannot
    be read to its end, gives no rows at all: it is named in a warning and, with
    its reason, in the JSON folder ``rejects``. The others are not read again for it.
    """
    root = f"{shared_root(spark)}/storm-files/{uuid.uuid4().hex}"
    targets = [f"{root}/{number}" for number in range(len(paths))]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        reasons = list(pool.map(lambda pair: _land(spark, *pair), zip(paths, targets)))
    refused = {path: reason for path, reason in zip(paths, reasons) if reason is not None}
    for path, reason in refused.items():
        logger.warning("skipping %s: %s", path, reason)
    if rejects is not None and refused:
        spark.createDataFrame(list(refused.items()), "path string, reason string").coalesce(1).write.mode("append").json(rejects)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in STORM_COLUMNS])
    landed = [target for target, reason in zip(targets, reasons) if reason is None]
    return spark.read.schema(schema).parquet(*landed) if landed else spark.createDataFrame([], schema)


def read_readings(spark: SparkSession, path: str, years: Sequence[int] | None = None, spread: int | None = None) -> DataFrame:
    """Headerless daily readings, named ``<year>.csv.gz``; only the four columns in use.

    ``years`` (see ``matching.active_years``) skips files no window touches. A
    gzip file is read by a single task; ``spread`` repartitions after that.
    """
    names = "{" + ",".join(map(str, years)) + "}" if years is not None else "[0-9][0-9][0-9][0-9]"
    raw = (
        spark.read.schema(READING_SCHEMA)
        .csv(f"{path}/{names}.csv.gz")
        .select("ID", "DATE", "ELEMENT", "VALUE")
    )
    return raw.repartition(spread) if spread else raw


def parse_stations(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fixed-width station lines as columns."""
    fields = []
    for name, (start, stop) in STATION_FIELDS.items():
        field = F.trim(F.substring(column, start + 1, stop - start))
        fields.append((numeric(field) if name in STATION_NUMBERS else field).alias(name))
    return lines.select(*fields)


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    return parse_stations(spark.read.text(path))
