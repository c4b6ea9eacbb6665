"""High-water marks and keyset paging."""

from pyspark.sql import Column, DataFrame, functions as F


def after_mark(time: str, key: str, last_time, last_key) -> Column:
    """Rows strictly after the composite mark (time, then key)."""
    t, k = F.col(time), F.col(key)
    return (t > F.lit(last_time)) | ((t == F.lit(last_time)) & (k > F.lit(last_key)))


def keyset_page(df: DataFrame, time: str, key: str, last_time, last_key, size: int) -> DataFrame:
    """The next page in (time, key) order after the mark; the filter reaches the scan."""
    rows = df if last_time is None else df.where(after_mark(time, key, last_time, last_key))
    return rows.orderBy(time, key).limit(size)


def high_water_mark(df: DataFrame, name: str, time: str, key: str) -> DataFrame:
    """Largest (time, key) of a dataset over all its rows, as text, one row."""
    top = F.max(F.struct(F.col(time).alias("t"), F.col(key).alias("k")))
    return (
        df.where(F.col(time).isNotNull())
        .agg(top.alias("_top"))
        .select(
            F.lit(name).alias("dataset"),
            F.col("_top.t").cast("string").alias("last_refresh"),
            F.col("_top.k").cast("string").alias("last_key"),
        )
    )
