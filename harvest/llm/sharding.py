"""Sharding by a hierarchical weighted hash tree: regions hold racks, racks hold shards.

At each level every child draws -ln(u) / weight with u from a hash of the key and the child's place, and the least draw wins;
the key descends into it. If a weight changes, the draws of the other children stay: keys move only into children that gain
weight or out of children that lose it, so movement stays within the subtrees whose weights change. A shard added as a region
of its own takes keys only into itself.

A null key is a key of its own. Repeated rows go to the same shard and take a slot each. A null text has no bytes. An
empty table gives an empty table; columns of any other name are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm.common import parts_for, with_running
from harvest.sources.scratch import written

SHARDS = 16
RACKS, PER_RACK = 2, 4
#: Equal rows that one row stands for while slots are counted.
COPIES = 1000
#: Regions of racks of (shard, weight).
Tree = list[list[list[tuple[int, float]]]]


def tree_of(shards: int, base: int = SHARDS, racks: int = RACKS, per_rack: int = PER_RACK) -> Tree:
    """Equal weights: the first `base` shards fill regions of `racks` racks of `per_rack` shards; each later shard is a region."""
    first = [[(s, 1.0) for s in range(at, min(at + per_rack, shards, base))] for at in range(0, min(shards, base), per_rack)]
    regions = [first[at : at + racks] for at in range(0, len(first), racks)]
    return regions + [[[(s, 1.0)]] for s in range(base, shards)]


def key_text(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("null"))


def _weight(node: list | tuple) -> float:
    return float(node[1]) if isinstance(node, tuple) else sum(map(_weight, node))


def _children(node: list, place: str) -> Column:
    """Children with weight as (place, weight, below): below is a shard, or the children of the child."""
    out = []
    for i, child in enumerate(node):
        if _weight(child) > 0:
            own = f"{place}/{child[0] if isinstance(child, tuple) else i}"
            below = F.lit(child[0]) if isinstance(child, tuple) else _children(child, own)
            out.append(F.struct(F.lit(own).alias("place"), F.lit(_weight(child)).alias("weight"), below.alias("below")))
    return F.array(*out)


def _winner(key: Column, children: Column) -> Column:
    """What lies below the child of the least draw."""

    def draw(child: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit(":"), child["place"])), 1, 13)
        unit = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
        return F.struct((-F.log(unit) / child["weight"]).alias("draw"), child["place"].alias("place"), child["below"].alias("below"))

    return F.array_min(F.transform(children, draw))["below"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key. Subtrees without weight get nothing."""
    if _weight(tree) <= 0:
        raise ValueError("no shard has weight")
    return _winner(key, _winner(key, _winner(key, _children(tree, ""))))


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, grown_shard (with one shard more) and slot of every row of `docs` (doc_id, text).

    Equal rows are counted first, and a row for at most `COPIES` of them is placed and written out again. Slots follow a hash of these
    rows and have no gaps. They are running counts of parts of a shard, so neither a shard nor an id meets in one task.
    """
    key = key_text(F.col("doc_id"))
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("__n"))
    placed = counted.withColumns({"shard": shard_of(key, tree_of(shards)), "grown_shard": shard_of(key, tree_of(shards + 1))})
    placed = written(placed, "sharding")
    parts = parts_for(placed.agg(F.sum("__n")).first()[0] or 0, 4000 * shards)
    chunk = F.explode(F.expr(f"sequence(0, (__n - 1) div {COPIES})"))
    here = F.least(F.lit(COPIES), F.col("__n") - F.col("__chunk") * COPIES)
    order = ["doc_id", "size", "text_crc32", "__chunk"]
    dealt = placed.withColumn("__chunk", chunk).withColumn("__n", here).withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    begun = with_running(dealt, {"__begun": F.col("__n")}, ["shard"], "__part", [F.col(c) for c in order])
    slot = F.explode(F.sequence(F.col("__begun"), F.col("__begun") + F.col("__n") - 1))
    return begun.select(*rows.columns, "shard", "grown_shard", slot.alias("slot"))
