"""Positions and quantiles against single-task definitions, on skewed data."""

import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from aftermath.operators.explore import box_numbers, describe, histogram
from aftermath.operators.quantiles import exact_quantiles
from aftermath.operators.ranking import with_position


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, dates with many ties, some null groups."""
    return spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("g"), F.col("id") % 37)).alias("g"),
        (F.hash("id") % 20).alias("day"),
        F.when(F.col("id") % 4 == 0, 5.0).otherwise(F.abs(F.hash("id", F.lit(7))) % 1000 / 8).alias("v"),
    ).cache()


@pytest.mark.parametrize("parts", [1, 7])
def test_position_equals_row_number(spark, skewed, parts):
    got = with_position(skewed, ["day", "id"], ["g"], parts=parts)
    want = skewed.withColumn(
        "want", F.when(F.col("g").isNotNull(), F.row_number().over(Window.partitionBy("g").orderBy("day", "id")) - 1)
    )
    wrong = got.join(want.select("id", "want"), "id").where(~F.col("position").eqNullSafe(F.col("want")))
    assert got.count() == 3000 and wrong.isEmpty()


def test_global_position_is_a_numbering(skewed):
    got = with_position(skewed, ["id"], name="n").where(F.col("n") != F.col("id"))
    assert got.isEmpty()


def test_prior_count_never_looks_ahead(skewed):
    """Dropping later rows leaves the counts of the earlier ones as they are."""
    full = with_position(skewed, ["day", "id"], ["g"])
    early = with_position(skewed.where("day <= 0"), ["day", "id"], ["g"], "cut")
    assert full.join(early.select("id", "cut"), "id").where(~F.col("position").eqNullSafe(F.col("cut"))).isEmpty()


@pytest.mark.parametrize("parts", [1, 5])
def test_quantiles_equal_numpy(skewed, parts):
    probabilities = {"q0": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q99": 0.99, "q100": 1.0}
    got = {r.g: r for r in exact_quantiles(skewed, "v", probabilities, ["g"], parts=parts).collect()}
    frame = skewed.toPandas()
    for group, rows in frame.groupby("g", dropna=False)["v"]:
        row = got[None if group != group or group is None else group]
        for name, p in probabilities.items():
            assert row[name] == pytest.approx(np.quantile(rows, p), abs=1e-9)


def test_describe_and_box_numbers(spark, skewed):
    row = describe(skewed, "v").head()
    series = skewed.toPandas()["v"]
    assert row.n == 3000 and row.q50 == series.quantile(0.5)
    assert row["std"] == pytest.approx(series.std())
    with_nan = spark.createDataFrame([("a", 1.0), ("a", float("nan")), ("a", None), ("a", 3.0), ("a", 100.0)], "g string, v double")
    box = box_numbers(with_nan, "g", "v").head()
    assert (box.n, box.q50, box.whisker_high) == (3, 3.0, 100.0)


def test_histogram_lists_empty_bins_and_closes_the_last(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    got = {r.bin: r.n for r in histogram(rows, "v", bins=5).collect()}
    assert got == {0: 2, 1: 0, 2: 0, 3: 0, 4: 1}
    flat = {r.bin: r.n for r in histogram(rows.where("v = 1.0"), "v", bins=2).collect()}
    assert flat == {0: 1, 1: 0}
