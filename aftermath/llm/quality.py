"""Quality rules and robust multivariate outliers (minimum covariance determinant), native expressions only."""

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from aftermath.llm.shared import Workspace, null_safe_key

BLANKS = r"[ \t-\r]+"
WINDOW = 5
# The statistics, each with the least standard deviation that counts as a difference.
FLOORS = {"x_words": 0.5, "x_length": 0.04, "x_symbols": 0.03, "x_lines": 0.1, "x_repeats": 0.15}
NAMES = tuple(FLOORS)
# The part of a group that the covariance must fit, and the chance that a normal row is refused.
HALF, REFUSED, STEPS = 0.75, 1e-7, 4
# A (language, source) group of fewer rows is judged by its language, that of fewer by all rows.
LEAST_ROWS = 200
BINS = 50  # of the distance, to a factor e


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once for the row, however often ``use`` reads it."""
    return F.transform(F.array(value), use)[0]


def _hashes(words: Column) -> Column:
    at = lambda i: F.xxhash64(*(F.element_at(words, (i + k).cast("int")) for k in range(1, WINDOW + 1)))
    return F.when(F.size(words) < WINDOW, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), at)
    )


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: the union of the windows' ranges."""

    def repeated(s: Column) -> Column:
        def twin(e: Column, k: Column) -> Column:
            before = (k > 0) & (F.try_element_at(s, F.greatest(k, F.lit(1)).cast("int"))["h"] == e["h"])
            after = F.coalesce(F.try_element_at(s, (k + 2).cast("int"))["h"] == e["h"], F.lit(False))
            return before | after

        return F.sort_array(F.transform(F.filter(s, twin), lambda e: e["i"]))

    def union(d: Column) -> Column:
        gap = lambda v, k: F.least(F.lit(WINDOW), F.coalesce(F.try_element_at(d, (k + 2).cast("int")) - v, F.lit(WINDOW)))
        return F.aggregate(F.transform(d, gap), F.lit(0).cast("long"), lambda a, x: a + x)

    pairs = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    some = bound(bound(pairs, repeated), union)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(some)


def counts(docs: DataFrame) -> DataFrame:
    """(doc_id, _group, _lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    of_words = bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), bound(_hashes(w), _covered).alias("repeated")))
    found = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.concat_ws("\u0001", null_safe_key(F.col("lang")), null_safe_key(F.col("source"))).alias("_group"),
        null_safe_key(F.col("lang")).alias("_lang"),
        of_words.alias("_words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )
    return found.select(
        "doc_id", "_group", "_lang", F.col("_words.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.col("_words.repeated").alias("n_repeat_words"),
    )


def vector() -> dict[str, Column]:
    """The transformed statistics; a mean word length leans on ten words of five characters."""
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "x_words": F.log(n.cast("double")),
        "x_length": F.log((F.col("word_chars") + 50) / (F.col("n_words") + 10)),
        "x_symbols": F.sqrt(F.col("n_symbols") / chars),
        "x_lines": F.sqrt(F.col("n_dup_lines") / n),
        "x_repeats": F.sqrt(F.col("n_repeat_words") / n),
    }


def chi_squared_below(x: float, d: int) -> float:
    """P(chi-squared with d degrees <= x), by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, half = d / 2, x / 2
    term = total = 1 / a
    k = a
    while term > total * 1e-16:
        k += 1
        term *= half / k
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi_squared_at(p: float, d: int) -> float:
    low, high = 0.0, 1e3
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_squared_below(middle, d) < p else (low, middle)
    return high


def _factor(model: DataFrame, scale: float) -> DataFrame:
    """From means and raw second moments: the inverse Cholesky factor w_ij of the floored covariance."""
    d = len(NAMES)
    for i, j in combinations_with_replacement(range(d), 2):
        moment = (F.col(f"s_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")) * scale
        # the floor is a variance of measurement, added to what the group shows
        model = model.withColumn(f"c_{j}_{i}", moment + (F.lit(FLOORS[NAMES[i]] ** 2) if i == j else F.lit(0.0)))
    for j in range(d):
        left = F.col(f"c_{j}_{j}") - sum((F.col(f"l_{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        # the floor is the least that a pivot can be, but for rounding
        model = model.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(left, F.lit(1e-3 * FLOORS[NAMES[j]] ** 2))))
        for i in range(j + 1, d):
            left = F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
            model = model.withColumn(f"l_{i}_{j}", left / F.col(f"l_{j}_{j}"))
    for i in range(d):
        model = model.withColumn(f"w_{i}_{i}", 1 / F.col(f"l_{i}_{i}"))
        for j in range(i - 1, -1, -1):
            dot = sum((F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)), F.lit(0.0))
            model = model.withColumn(f"w_{i}_{j}", -dot / F.col(f"l_{i}_{i}"))
    return model.select("_key", *(f"m_{i}" for i in range(d)), *(f"w_{i}_{j}" for i in range(d) for j in range(i + 1)))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to the model joined to it."""
    rows = (
        sum((F.col(f"w_{i}_{j}") * (F.col(NAMES[j]) - F.col(f"m_{j}")) for j in range(i + 1)), F.lit(0.0))
        for i in range(len(NAMES))
    )
    return sum((r * r for r in rows), F.lit(0.0))


def _moments(rows: DataFrame) -> DataFrame:
    d = len(NAMES)
    means = [F.avg(NAMES[i]).alias(f"m_{i}") for i in range(d)]
    squares = [F.avg(F.col(NAMES[i]) * F.col(NAMES[j])).alias(f"s_{i}_{j}") for i, j in combinations_with_replacement(range(d), 2)]
    return rows.groupBy("_key").agg(*means, *squares)


def _nearest(rows: DataFrame, model: DataFrame) -> DataFrame:
    """The rows of each group up to the distance bin that completes ``HALF`` of it."""
    measured = rows.join(model, "_key").withColumn("_d", _distance())
    measured = measured.withColumn("_bin", F.floor(BINS * F.log(F.col("_d") + 1e-6)))
    upto = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = measured.groupBy("_key", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    bins = bins.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
    bins = bins.withColumn("_all", F.sum("_n").over(Window.partitionBy("_key")))
    last = bins.where(F.col("_before") < HALF * F.col("_all")).groupBy("_key").agg(F.max("_bin").alias("_last"))
    return measured.join(last, "_key").where("_bin <= _last").select("_key", *NAMES)


def fit(space: Workspace, rows: DataFrame) -> DataFrame:
    """The model (centre, inverse factor) of each ``_key`` of the written ``rows``.

    The deterministic start is the medians and absolute deviations of each
    group; each concentration step fits the nearest 75 % of the group anew,
    which never raises the determinant. Steps are grouped sums over all rows; a
    group of any size is summed in parts.
    """
    d = len(NAMES)
    middle = rows.groupBy("_key").agg(*(F.percentile_approx(x, 0.5, 1000).alias(f"m_{i}") for i, x in enumerate(NAMES)))
    spread = rows.join(middle, "_key").groupBy("_key").agg(
        *(F.first(f"m_{i}").alias(f"m_{i}") for i in range(d)),
        *(F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 1000).alias(f"a_{i}") for i, x in enumerate(NAMES)),
    )
    for i, j in combinations_with_replacement(range(d), 2):
        square = (1.4826 * F.col("a_%d" % i)) ** 2 if i == j else F.lit(0.0)
        spread = spread.withColumn(f"s_{i}_{j}", F.col(f"m_{i}") * F.col(f"m_{j}") + square)
    model = space.write(_factor(spread, 1.0), "start")
    scale = HALF / chi_squared_below(chi_squared_at(HALF, d), d + 2)
    for step in range(STEPS):
        model = space.write(_factor(_moments(_nearest(rows, model)), scale), f"step-{step}")
    return model


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance) of every row.

    Rows that the base rules pass are judged against the robust centre and
    covariance of their language and source; null counts as a language and as
    a source. Null and empty texts fail the base rules and have no distance.
    Repeated rows are judged alike and count each. Other columns are ignored.
    """
    space = Workspace(docs.sparkSession, "quality")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = space.write(counts(docs).withColumn("base_failed", failed).withColumns(vector()), "counts")
    passed = rows.where(~F.col("base_failed"))
    groups = passed.groupBy("_group", "_lang").agg(F.count(F.lit(1)).alias("_n"))
    of_lang = groups.groupBy("_lang").agg(F.sum("_n").alias("_m"))
    key = F.when(F.col("_n") >= LEAST_ROWS, F.concat(F.lit("group "), F.col("_group")))
    key = key.when(F.col("_m") >= LEAST_ROWS, F.concat(F.lit("lang "), F.col("_lang"))).otherwise("all")
    keys = space.write(groups.join(of_lang, "_lang").select("_group", "_lang", key.alias("_key")), "keys")
    # every row belongs to its group, its language and all; only what judges some group is fitted
    levels = F.explode(F.array(F.concat(F.lit("group "), F.col("_group")), F.concat(F.lit("lang "), F.col("_lang")), F.lit("all")))
    population = passed.select(levels.alias("_key"), *NAMES).join(keys.select("_key").distinct(), "_key", "left_semi")
    model = fit(space, space.write(population, "population"))
    judge = keys.join(model, "_key").drop("_lang", "_key")
    cut = chi_squared_at(1 - REFUSED, len(NAMES))
    distance = F.when(F.col("base_failed"), F.lit(None)).otherwise(_distance())
    return rows.join(judge, "_group", "left").withColumn("distance", distance).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(F.col("distance") <= cut, F.lit(True))).alias("kept"), "distance",
    )
