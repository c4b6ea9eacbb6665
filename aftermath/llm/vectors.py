"""Columns of embedding vectors as matrices, inside tasks."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def common_width(rows: DataFrame, column: str) -> int:
    """The length that most vectors of an array column have; of equals the largest; 0 without vectors."""
    lengths = rows.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("width")).agg(F.count(F.lit(1)).alias("n"))
    found = lengths.agg(F.max_by("width", F.struct("n", "width"))).head()[0]
    return found or 0


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lists are vectors of ``width`` finite numbers, and these as the rows of a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    right = (sizes == width) & column.is_valid().to_numpy(zero_copy_only=False)
    if not right.all():
        column = column.filter(pa.array(right))
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry becomes NaN
    values = values.reshape(len(column), width) if width else np.zeros((len(column), 0))
    good = np.isfinite(values).all(1)
    kept = np.flatnonzero(right)[good]
    return kept, values[good]
