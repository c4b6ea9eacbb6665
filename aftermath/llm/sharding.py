"""Shards by a hierarchical weighted hash tree: region, rack, shard."""

import math

from pyspark.sql import Column, DataFrame, functions as F

from aftermath.llm.shared import Workspace, running_totals, unit

# A tree: region -> rack -> {shard: weight}
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(shards: int, racks: int = 2, per_rack: int = 4) -> Tree:
    """Equal shards, ``per_rack`` to a rack and ``racks`` racks to a region."""
    tree: Tree = {}
    for shard in range(shards):
        rack, region = shard // per_rack, shard // (per_rack * racks)
        tree.setdefault(f"region{region}", {}).setdefault(f"rack{rack}", {})[shard] = 1.0
    return tree


def grown(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard in a region of its own.

    A draw depends on the child and its own weight alone, so a new region takes
    keys from the others and changes no draw inside them: rows move only to it.
    """
    return {**tree, f"region-of-{shard}": {f"rack-of-{shard}": {shard: weight}}}


def weight_of(node) -> float:
    return sum(map(weight_of, node.values())) if isinstance(node, dict) else float(node)


def _drawn(key: Column, path: str, children: dict) -> Column:
    """The child with the shortest straw, -ln(u) / weight: chosen in proportion to its weight."""
    straws = []
    for name, node in children.items():
        straw = -F.log(unit(F.xxhash64(F.lit(f"{path}/{name}"), key))) / F.lit(weight_of(node))
        straws.append(F.struct(straw.alias("straw"), F.lit(str(name)).alias("name")))
    return F.array_min(F.array(*straws))["name"] if len(straws) > 1 else F.lit(str(next(iter(children))))


def descend(df: DataFrame, key: str, tree: Tree, prefix: str = "") -> DataFrame:
    """Add region, rack and shard of every row, level by level.

    Children of weight zero get no rows. A changed weight moves rows between
    the subtree in which it changed and its siblings; all other draws stay.
    """
    live = {r: {k: {s: w for s, w in ss.items() if w > 0} for k, ss in racks.items()} for r, racks in tree.items()}
    live = {r: {k: ss for k, ss in racks.items() if ss} for r, racks in live.items()}
    live = {r: racks for r, racks in live.items() if racks}
    if not live or not all(math.isfinite(weight_of(x)) for x in live.values()):
        raise ValueError("a tree needs a shard of positive, finite weight")
    region, rack, shard = (f"{prefix}{x}" for x in ("region", "rack", "shard"))
    df = df.withColumn(region, _drawn(F.col(key), "", live))
    levels = F.lit(None).cast("string")
    for name, racks in live.items():
        levels = F.when(F.col(region) == name, _drawn(F.col(key), name, racks)).otherwise(levels)
    df = df.withColumn(rack, levels)
    leaf = F.lit(None).cast("string")
    for name, racks in live.items():
        for inner, shards in racks.items():
            here = (F.col(region) == name) & (F.col(rack) == inner)
            leaf = F.when(here, _drawn(F.col(key), f"{name}/{inner}", shards)).otherwise(leaf)
    return df.withColumn(shard, leaf.cast("int"))


def sharded(docs: DataFrame, tree: Tree, larger: Tree, apart: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, region, rack) of every row of ``docs``.

    Law ``key``: the id and the tree decide alone. ``larger`` has one more
    shard, see ``grown``. Slots number a shard's rows from 0 by a hash of the
    id, in which rows of one id are neighbours; with ``apart`` the place of a
    row in the input counts too, so that they are not. A null text has size 1 and the checksum of nothing. A null doc_id is a
    key like any other. Repeated rows go to one shard and get a slot each.
    Other columns are ignored.
    """
    space = Workspace(docs.sparkSession, "sharding")
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_key"),
    )
    placed = descend(descend(base, "_key", larger, "_grown_"), "_key", tree)
    # written below, so a row keeps its draw
    salt = [F.monotonically_increasing_id()] if apart else []
    placed = placed.withColumn("_draw", F.xxhash64(F.lit("slot"), "_key", *salt))
    placed = space.write(placed.drop("_key", "_grown_region", "_grown_rack"), "placed")
    slots = running_totals(space, placed, "shard", "_draw", ["doc_id", "text_crc32"], "size")
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("row_no").cast("long").alias("slot"),
        F.col("_grown_shard").alias("grown_shard"),
        "region",
        "rack",
    )
