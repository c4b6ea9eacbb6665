"""Incremental merging of keyed records."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.operators.ranking import keep_first

NEW, UPDATED, UNCHANGED, STALE = "new", "updated", "unchanged", "stale"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows; a column that a frame lacks is null there."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def keep_latest(
    df: DataFrame, keys: Sequence[str], cursor: str, arrival: Sequence[str] = ()
) -> DataFrame:
    """The newest version of each key: highest cursor, then latest arrival.

    Further columns break remaining ties, so replays and file order do not matter.
    """
    leading = [cursor, *arrival]
    rest = [c for c in df.columns if c not in leading and c not in keys]
    order = [F.desc_nulls_last(c) for c in leading] + [F.desc_nulls_last(c) for c in rest]
    return keep_first(df, keys, order)


def with_arrival(df: DataFrame, arrival: int | Column) -> DataFrame:
    column = arrival if isinstance(arrival, Column) else F.lit(arrival)
    return df.withColumn("_arrival", column.cast("long"))


def merge(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], cursor: str) -> DataFrame:
    """Existing and incoming records united, one newest version per key."""
    united = union_by_name(with_arrival(existing, 0), with_arrival(incoming, 1))
    return keep_latest(united, keys, cursor, ["_arrival"]).drop("_arrival")


def merge_report(name: str, existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing, incoming, removed and final row counts of a merge, in one aggregation."""
    sides = existing.select(*keys, F.lit(0).alias("_new")).unionByName(
        incoming.select(*keys, F.lit(1).alias("_new"))
    )
    per_key = sides.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.sum("_new").alias("_in"))
    return per_key.agg(
        F.lit(name).alias("dataset"),
        F.coalesce(F.sum(F.col("_n") - F.col("_in")), F.lit(0)).alias("existing_rows"),
        F.coalesce(F.sum("_in"), F.lit(0)).alias("new_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"),
        F.count(F.lit(1)).alias("final_rows"),
    )


def _same_values(left: str, right: str, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def classify(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], cursor: str, few: bool = True
) -> DataFrame:
    """Incoming records, newest per key, with what each means for the stored table.

    ``new``: key not stored. ``unchanged``: same values in the columns both
    sides have, nulls being equal, and no value in a column that the stored
    table lacks. ``stale``: an older version than the stored one; a null cursor
    is older than any value. ``updated``: anything else. ``few`` says that the
    incoming keys may be few; it changes the plan only.
    """
    shared = [c for c in incoming.columns if c in existing.columns and c not in keys]
    fresh = keep_latest(incoming, keys, cursor).alias("i")
    # Only stored rows of incoming keys are of interest. The semi join lets Spark
    # broadcast the keys of a small batch instead of shuffling the stored table;
    # a large batch would only be read once more for it.
    stored = known_rows(existing, incoming, keys) if few else existing
    stored = stored.withColumn("_stored", F.lit(True)).alias("e")
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"i.{key}") == F.col(f"e.{key}"))
    added = [F.col(f"i.{c}").isNotNull() for c in incoming.columns if c not in existing.columns]
    adds = F.array_contains(F.array(*added), True) if added else F.lit(False)
    ours, theirs = F.col(f"i.{cursor}"), F.col(f"e.{cursor}")
    outcome = (
        F.when(F.col("e._stored").isNull(), NEW)
        .when(_same_values("i", "e", shared) & ~adds, UNCHANGED)
        .when(F.coalesce(ours < theirs, ours.isNull() & theirs.isNotNull()), STALE)
        .otherwise(UPDATED)
    )
    return fresh.join(stored, on, "left").select("i.*", outcome.alias("outcome"))


def compare_records(left: DataFrame, *others: DataFrame) -> DataFrame:
    """One row: ``n`` rows of ``left``, and ``same``, whether each of ``others`` holds the same rows the same number of times (null = null).

    A column that one side lacks counts as null there. All sides meet in one
    grouping. Sides that lie dealt out by the same keys, as those of ``merge``
    and ``keep_latest`` do, are compared where they lie; written ones
    (``durable``) no longer do, so rows move once more for these.
    """
    sides = [df.withColumn("_side", F.lit(i)) for i, df in enumerate((left, *others))]
    tagged = union_by_name(*sides)
    columns = [F.col(f"`{c}`") for c in tagged.columns if c != "_side"]
    counts = [F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(sides))]
    equal = [F.coalesce(F.bool_and(F.col("_n0") == F.col(f"_n{i}")), F.lit(True)) for i in range(1, len(sides))]
    records = tagged.groupBy(*columns).agg(*counts)
    return records.agg(F.coalesce(F.sum("_n0"), F.lit(0)).alias("n"), F.array(*equal).alias("same"))


def same_records(left: DataFrame, right: DataFrame) -> bool:
    """Whether two batches hold the same rows the same number of times (null = null).

    A column that one side lacks counts as null there.
    """
    return compare_records(left, right).head().same[0]


def known_rows(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``others``.

    The keys are made distinct first: a key that fills a third of ``others``
    is one row in the join then.
    """
    return rows.join(others.select(*keys).distinct(), list(keys), "left_semi")


def new_rows(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``others``."""
    return rows.join(others.select(*keys).distinct(), list(keys), "left_anti")


def key_sets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of both sides with where they occur: left, right or both."""
    sides = left.select(*keys, F.lit(1).alias("_side")).unionByName(right.select(*keys, F.lit(2).alias("_side")))
    seen = sides.dropna(subset=list(keys)).groupBy(*keys).agg(
        F.min("_side").alias("_low"), F.max("_side").alias("_high")
    )
    where = F.when(F.col("_low") < F.col("_high"), "both").when(F.col("_low") == 1, "left").otherwise("right")
    return seen.select(*keys, where.alias("side"))
