"""Mixing sources to target weights: temperature, token budget, block permutations."""

import math

from pyspark.sql import DataFrame, functions as F

from aftermath.llm.shared import Workspace, null_safe_key, running_totals

WORDS = r"[ \t-\r]+"


def tempered(tokens: dict[str, float], exponent: float) -> dict[str, float]:
    """Normalised weights: token shares to the power ``exponent``; sources without tokens get none."""
    total = sum(tokens.values())
    raised = {s: (n / total) ** exponent for s, n in tokens.items() if n > 0}
    whole = sum(raised.values())
    return {s: x / whole for s, x in raised.items()}


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def passes(tokens: dict[str, float], weights: dict[str, float]) -> dict[str, float]:
    """How often each source is read if the least repeated one is read exactly once."""
    rates = {s: w / tokens[s] for s, w in weights.items()}
    least = min(rates.values())
    return {s: r / least for s, r in rates.items()}


def exponent_for(tokens: dict[str, float], max_entropy: float, max_passes: float) -> float:
    """The smallest exponent in [0, 1] within both limits, by bisection.

    Entropy and repetition fall as the exponent grows from even shares (0) to
    natural ones (1). ``max_entropy`` is a part of the possible entropy.
    """
    live = {s: n for s, n in tokens.items() if n > 0}

    def allowed(exponent: float) -> bool:
        weights = tempered(live, exponent)
        flat = math.log(len(live)) if len(live) > 1 else 1.0
        return entropy(weights) <= max_entropy * flat + 1e-12 and max(passes(live, weights).values()) <= max_passes + 1e-12

    if not live or allowed(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if allowed(middle) else (middle, high)
    return high


def mixed(docs: DataFrame, max_entropy: float = 0.995, max_passes: float = 2.0, block_tokens: int = 1 << 20, seed: int = 7) -> DataFrame:
    """(doc_id, source, pass, n_tokens, block, position) of the mixture: one row for each reading of a document.

    Tokens are words. Source weights are ``tempered`` with ``exponent_for``.
    The budget is the smallest at which every source is read once in full, so
    no document is lost; a source above it is read again, the last time up to
    its budget (the document that crosses it is included). Each pass permutes a
    source by a hash of seed, pass and id. A row's place in the source's budget,
    from 0 to 1, names its block: every block holds all sources in their
    weights, ``block_tokens`` together, and is permuted by another hash
    (``position`` orders it). Documents without words are read once. A null
    source is a source. Repeated rows and equal ids are read each for itself.
    Only one number for each source reaches the driver.
    """
    space = Workspace(docs.sparkSession, "mixing")
    words = F.size(F.filter(F.split(F.coalesce(F.col("text").cast("string"), F.lit("")), WORDS), lambda w: w != ""))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        null_safe_key(F.col("source")).alias("_source"),
        words.cast("long").alias("n_tokens"),
    )
    base = space.write(base, "tokens")
    shares = base.groupBy("_source").agg(F.sum("n_tokens").alias("n")).orderBy("_source").collect()
    tokens = {r[0]: float(r[1]) for r in shares}
    exponent = exponent_for(tokens, max_entropy, max_passes)
    live = {s: n for s, n in tokens.items() if n > 0}
    rates = passes(live, tempered(live, exponent)) if live else {}
    # A whole number of readings that floating point misses by a hair is that number.
    plan = [(s, (r := rates.get(s, 1.0)), int(math.ceil(r - 1e-9)), max(1.0, r * tokens[s])) for s in tokens]
    plan = docs.sparkSession.createDataFrame(plan, "_source string, rate double, readings int, quota double")
    total = sum(rates[s] * n for s, n in live.items())
    blocks = max(1, math.ceil(total / block_tokens))
    # one row for each source is broadcast; their number is that of the collected shares above
    read = base.join(F.broadcast(plan), "_source")
    read = read.withColumn("pass", F.explode(F.expr("sequence(1, if(n_tokens = 0, 1, readings))")))
    read = read.withColumn("_draw", F.xxhash64(F.lit(seed), "pass", "doc_id"))
    read = read.withColumn("_stream", F.concat_ws("/", F.col("pass").cast("string"), "_source"))
    read = space.write(read, "read")
    placed = running_totals(space, read, "_stream", "_draw", ["doc_id", "n_tokens"], "n_tokens")
    # the whole passes before this one hold (pass - 1) times the source's tokens
    upto = F.col("before") + (F.col("pass") - 1) * F.col("total")
    kept = placed.withColumn("_place", upto / F.col("quota")).where((F.col("pass") == 1) | (F.col("_place") < 1))
    return kept.select(
        "doc_id",
        "source",
        "pass",
        "n_tokens",
        F.least(F.floor(F.col("_place") * blocks), F.lit(blocks - 1)).cast("long").alias("block"),
        F.xxhash64(F.lit("block"), F.lit(seed), "pass", "doc_id").alias("position"),
    )
