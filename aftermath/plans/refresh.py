"""Derived tables kept up to date from the changes of a stored table."""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from aftermath.operators.merging import union_by_name
from aftermath.operators.ranking import same_keys


def refreshed(
    previous: DataFrame, rows: DataFrame, changes: DataFrame, keys: Sequence[str], build: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """A derived table after some rows of its source changed.

    ``build`` makes the derived table of any set of whole groups (rows of equal
    ``keys``), and its result has ``keys``. Groups that a changed row is or was
    in (``changes`` has both, as ``KeyedStore.changes`` gives them) are built
    again from ``rows``; the others stay as they are. A null key is a group of
    its own. An empty ``changes`` gives ``previous``.
    """
    touched = changes.select(*keys).distinct().withColumn("_touched", F.lit(True))
    kept = previous.alias("p").join(touched.alias("t"), same_keys("p", "t", keys), "left_anti")
    again = rows.alias("r").join(touched.alias("t"), same_keys("r", "t", keys), "left_semi")
    return union_by_name(kept, build(again))
