"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvest.sources.scratch import written


def _smallest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node that it sees."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hands its smaller neighbours, and itself, to the smallest of them."""
    least = _smallest(edges)
    handed = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return handed.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (u, v); root is the smallest node that it reaches.

    Large and small stars in turn, until nothing changes; the number of rounds grows with the logarithm of the nodes. Each
    round is a table in the shared folder. Only minima are gathered for a node, never its neighbours, so a node with very
    many neighbours is one skewed join key, which Spark splits.
    """
    now = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    now, before = written(now, "edges"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = state
        now = written(_small_star(_large_star(now)), "edges")
