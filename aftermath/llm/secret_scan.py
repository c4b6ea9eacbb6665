"""Secret scans: fixed patterns, and a battery of randomness tests under false-discovery control. Native expressions only."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.llm.quality import bound
from aftermath.llm.shared import Workspace

# The base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # runs are taken whole, so the least length can stand in the pattern
HEX = r"[0-9a-f]{32,}"
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
# Text to compare with: chance that two letters are equal, that three are, and of a change of character class.
SAME_TWO, SAME_THREE, CHANGE = 0.065, 0.0055, 0.12
# A token must look random to each test at this level, and the share of false finds among all finds is to be this.
REJECT_Z, FALSE_SHARE = 3.3, 0.01
# Lengths from which tokens are one family of hypotheses.
LENGTHS = (20, 24, 32, 40, 64, 128)


def _placed(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches as (a, b, m): code points, end exclusive, and the matched text."""

    def places(matches: Column, pieces: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int,m:string>>").alias("out"))

        def step(acc: Column, pair: Column) -> Column:
            a = acc["at"] + F.length(pair["p"])
            b = a + F.length(pair["m"])
            one = F.array(F.struct(a.alias("a"), b.alias("b"), pair["m"].alias("m")))
            return F.struct(b.alias("at"), F.concat(acc["out"], one).alias("out"))

        pairs = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)), lambda m, p: F.struct(m.alias("m"), p.alias("p")))
        return F.aggregate(pairs, start, step, lambda acc: acc["out"])

    none = F.array().cast("array<struct<a:int,b:int,m:string>>")
    return bound(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) == 0, none).otherwise(places(m, F.split(text, pattern, -1))),
    )


def _spans(found: Column, kind: str) -> Column:
    at = KINDS.index(kind)
    return F.transform(found, lambda x: F.struct(x["a"].alias("a"), F.lit(at).alias("k"), x["b"].alias("b")))


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    show = lambda s: F.concat_ws(":", names[s["k"]], s["a"].cast("string"), s["b"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), show), ",")


def battery(token: Column) -> Column:
    """Statistics of a token: ``z`` (how unlike text) and ``odd`` (the worst randomness test, in standard deviations).

    The encoding is inferred from the characters: 16, 32, 62 or 64 symbols.
    Three tests are for randomness: chi-squared of the symbol counts, runs
    above and below the middle of the alphabet, and the correlation of
    neighbours. ``z`` joins two tests against text: the symbol counts are more
    even than letters of text, and letters, capitals and digits alternate more.
    """
    body = F.regexp_replace(token, "=+$", "")

    def of(t: Column) -> Column:
        n = F.length(t).cast("double")
        size = (
            F.when(t.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16.0)
            .when(t.rlike("^[A-Z2-7]+$"), 32.0)
            .when(t.rlike("^[A-Za-z0-9]+$"), 62.0)
            .otherwise(64.0)
        )
        chars = F.filter(F.split(t, ""), lambda c: c != "")
        squares = F.aggregate(
            F.transform(F.array_distinct(chars), lambda c: F.length(t) - F.length(F.replace(t, c, F.lit("")))),
            F.lit(0.0),
            lambda a, c: a + c * c,
        )
        # the place of a symbol in its alphabet, from 0 to 1
        symbols = F.when(size == 16.0, F.lit("0123456789abcdef")).when(size == 32.0, F.lit(ALPHABET[:26] + "234567")).otherwise(F.lit(ALPHABET))
        shown = F.when(size == 16.0, F.lower(t)).otherwise(t)
        places = F.transform(F.filter(F.split(shown, ""), lambda c: c != ""), lambda c: (F.position(c, symbols) - 0.5) / size)
        classes = F.translate(
            F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[a-z]", "a"), "[A-Z]", "b"), "[0-9]", "c"), "+/_-=", "ddddd"
        )
        runs = F.length(F.regexp_replace(classes, r"(.)\1*", "x")).cast("double")
        return F.struct(n.alias("n"), size.alias("size"), squares.alias("squares"), places.alias("places"), runs.alias("runs"))

    def tests(s: Column) -> Column:
        n, size, places = s["n"], s["size"], s["places"]
        even = size / n * s["squares"] - n
        z_even = (even - (size - 1)) / F.sqrt(2 * (size - 1))
        sum_of = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
        high = sum_of(F.transform(places, lambda x: F.when(x > 0.5, 1.0).otherwise(0.0)))
        pairs = F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places)), lambda x, y: F.struct(x.alias("x"), y.alias("y")))
        turns = sum_of(F.transform(pairs, lambda p: F.when((p["x"] > 0.5) != (p["y"] > 0.5), 1.0).otherwise(0.0)))
        expected = 2 * high * (n - high) / n
        variance = F.greatest(expected * (expected - 1) / (n - 1), F.lit(1e-9))
        z_runs = F.when(expected > 1, (turns - expected) / F.sqrt(variance)).otherwise(F.lit(99.0))
        mean = sum_of(places) / n
        total = sum_of(F.transform(places, lambda x: (x - mean) * (x - mean)))
        serial = sum_of(F.transform(pairs, lambda p: (p["x"] - mean) * (p["y"] - mean))) / F.greatest(total, F.lit(1e-9))
        z_serial = (serial + 1 / n) * F.sqrt(n)
        odd = F.greatest(z_even, F.abs(z_runs), F.abs(z_serial))
        text_even = n * (size * SAME_TWO - 1) + size * (1 - SAME_TWO)
        text_sd = F.sqrt(2 * (size - 1) + 4 * n * size * size * (SAME_THREE - SAME_TWO**2))
        z_text = (text_even - even) / text_sd
        z_class = (s["runs"] - 1 - (n - 1) * CHANGE) / F.sqrt((n - 1) * CHANGE * (1 - CHANGE))
        z = (z_text + z_class) / math.sqrt(2)
        return F.struct(F.coalesce(z, F.lit(-99.0)).alias("z"), F.coalesce(odd, F.lit(99.0)).alias("odd"))

    return bound(bound(body, of), tests)


def _family(length: Column) -> Column:
    family = F.lit(0)
    for i, least in enumerate(LENGTHS):
        family = F.when(length >= least, i).otherwise(family)
    return family


def thresholds(bins: list[tuple[int, int, int]]) -> dict[int, float]:
    """For each family of lengths the least ``z`` at which false finds are ``FALSE_SHARE`` of the finds.

    ``bins`` are (family, floor(10 z), count), at most a few hundred to a
    family. This is the step-up procedure on upper tail probabilities.
    """
    out = {}
    for family in {f for f, _, _ in bins}:
        own = sorted(((b, n) for f, b, n in bins if f == family), reverse=True)
        m, found, least = sum(n for _, n in own), 0, math.inf
        for b, n in own:
            found += n
            if math.erfc(b / 10 / math.sqrt(2)) / 2 * m <= FALSE_SHARE * found:
                least = b / 10
        out[family] = least
    return out


def secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) of every row.

    Null texts are empty; empty texts have no spans. Spans are counted in code
    points. Repeated rows are scanned each and are hypotheses each. A token
    that overlaps a base span is not tested. Other columns are ignored. Only
    the histogram of ``z`` reaches the driver.
    """
    space = Workspace(docs.sparkSession, "secrets")
    text = F.col("_text")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    none = F.array().cast("array<struct<a:int,b:int,m:string>>")
    low = F.lower(text)
    worded = bound(low, lambda t: F.exists(F.array(*(F.lit(k) for k in KEYWORDS)), lambda k: F.contains(t, k)))
    long_enough = lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 8
    assign = F.when(worded, F.filter(_placed(text, ASSIGN), long_enough)).otherwise(none)
    access = F.when(F.contains(text, F.lit("AKIA")), _placed(text, ACCESS)).otherwise(none)
    found = base.select(
        "doc_id",
        _spans(assign, "assign").alias("assign"),
        _spans(access, "access").alias("access"),
        _spans(_placed(text, HEX), "hex").alias("hex"),
        _placed(text, CANDIDATE).alias("tokens"),
    )
    found = found.withColumn("base", F.concat("assign", "access", "hex"))
    apart = F.filter("tokens", lambda t: ~F.exists("base", lambda s: (s["a"] < t["b"]) & (t["a"] < s["b"])))
    found = found.withColumn("tokens", apart)
    tested = lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), battery(t["m"]).alias("s"))
    found = found.withColumn("tokens", F.transform("tokens", tested))
    # a token that fails a randomness test is no find, but counts as a hypothesis
    z = lambda t: F.when(t["s"]["odd"] <= REJECT_Z, t["s"]["z"]).otherwise(F.lit(-99.0))
    tokens = F.transform("tokens", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), F.greatest(F.least(z(t), F.lit(99.0)), F.lit(-99.0)).alias("z")))
    rows = space.write(found.withColumn("tokens", tokens).drop("base"), "tokens")
    bins = (
        rows.select(F.explode("tokens").alias("t"))
        .groupBy(_family(F.col("t.b") - F.col("t.a")).alias("family"), F.floor(F.col("t.z") * 10).cast("int").alias("bin"))
        .count()
        .collect()
    )
    least = thresholds([tuple(r) for r in bins])
    needed = lambda t: F.element_at(F.array(*(F.lit(least.get(i, math.inf)) for i in range(len(LENGTHS)))), _family(t["b"] - t["a"]) + 1)
    random = F.filter("tokens", lambda t: F.floor(t["z"] * 10) / 10 >= needed(t))
    base = F.concat("assign", "access", "hex")
    return rows.select(
        "doc_id",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, _spans(random, "random"))).alias("spans"),
        F.size(random).cast("long").alias("n_random"),
    )
