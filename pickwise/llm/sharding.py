"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards. Every shard has a weighted draw per key: an exponential
number with the shard's weight as rate, made from a hash of key and shard. The draw of a rack is
the least of its shards', that of a region the least of its racks' (the least of exponential draws
is an exponential draw with the sum of the weights), and a row descends to the least draw on each
level. A draw depends on its own weight alone, so when a weight changes only keys that the changed
subtree wins or loses move, and a new shard takes keys from all others but gives none: the law is
``key``.

Rows of one key share a shard; the numbers inside a shard are gapless and assigned in bounded
buckets of rows, so neither a hot key nor a large shard meets in one task. Null texts count as
empty, a null key is a key of its own, repeated rows get slots of their own, an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.workspace import materialize

#: Rows of one input partition that are numbered together.
BUCKET_ROWS = 1 << 16
#: Bytes that a row counts besides its text.
ROW_BYTES = 16

Rack = tuple[tuple[int, float], ...]
Tree = tuple[tuple[Rack, ...], ...]


def hash_tree(
    shards: int, shards_per_rack: int = 4, racks_per_region: int = 4, weights: list[float] | None = None
) -> Tree:
    """Shards 0 to ``shards`` - 1 in racks and regions, filled in order."""
    leaves = [(n, float(weights[n]) if weights else 1.0) for n in range(shards)]
    racks = [tuple(leaves[a : a + shards_per_rack]) for a in range(0, shards, shards_per_rack)]
    return tuple(
        tuple(racks[a : a + racks_per_region]) for a in range(0, len(racks), racks_per_region)
    )


def _draw(key: Column, shard: int, weight: float) -> Column:
    """An exponential draw with rate ``weight``; never zero, as the hash is shifted by a half."""
    text = F.concat(F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null")), F.lit(f":{shard}"))
    part = F.shiftrightunsigned(F.xxhash64(text), 12).cast("double")
    return -F.log((part + 0.5) / float(1 << 52)) / weight


def _least(children: list[tuple[Column, Column]]) -> tuple[Column, Column]:
    """Draw and choice of a subtree from those of its children; the first wins a tie."""
    if len(children) == 1:
        return children[0]
    best = F.array_min(
        F.array(
            *[
                F.struct(draw.alias("draw"), F.lit(n).alias("at"), choice.alias("choice"))
                for n, (draw, choice) in enumerate(children)
            ]
        )
    )
    return best["draw"], best["choice"]


def add_shard(rows: DataFrame, key: str, trees: dict[str, Tree]) -> DataFrame:
    """``rows`` with one column per tree: the shard of the key column in that tree.

    Draws are computed once per shard and level, also where the trees share them.
    """
    leaves = sorted({leaf for tree in trees.values() for region in tree for rack in region for leaf in rack})
    draws = {leaf: f"__draw_{n}" for n, leaf in enumerate(leaves)}
    out = rows.withColumns({name: _draw(F.col(key), *leaf) for leaf, name in draws.items()})
    steps: dict[tuple, str] = {}

    def column(subtree: tuple, children: list[tuple[Column, Column]]) -> tuple[Column, Column]:
        nonlocal out
        if subtree not in steps:
            steps[subtree] = name = f"__best_{len(steps)}"
            draw, choice = _least(children)
            out = out.withColumn(name, F.struct(draw.alias("draw"), choice.alias("choice")))
        best = F.col(steps[subtree])
        return best["draw"], best["choice"]

    chosen = {}
    for name, tree in trees.items():
        regions = []
        for region in tree:
            racks = [
                column(("rack", rack), [(F.col(draws[x]), F.lit(x[0])) for x in rack])
                for rack in region
            ]
            regions.append(column(("region", region), racks))
        chosen[name] = column(("root", tree), regions)[1].cast("int")
    return out.select(*rows.columns, *[c.alias(name) for name, c in chosen.items()])


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Size, checksum, shard, slot and the shard with one more per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sized = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.floor(F.monotonically_increasing_id() / BUCKET_ROWS).cast("long").alias("bucket"),
    )
    trees = {"shard": hash_tree(shards), "grown_shard": hash_tree(shards + 1)}
    # Written once: the buckets must be the same ones when they are counted and when rows are numbered.
    placed = materialize(add_shard(sized, "doc_id", trees), "shards")
    ordered = Window.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = placed.withColumn("within", F.row_number().over(ordered) - 1)
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "bucket")
        .agg(F.count("*").alias("rows"))
        .select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    )
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("within")).cast("long").alias("slot"),
        "grown_shard",
    )
