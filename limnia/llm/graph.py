"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.llm.common import stored


def _mark(edges: DataFrame) -> tuple:
    """Differs between two edge tables unless they hold the same edges; halves of hashes are summed, which can't overflow."""
    h = F.xxhash64("u", "v")
    low = F.shiftright(F.shiftleft(h, 32), 32)
    row = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 32)), F.sum(low), F.bit_xor(h)).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m")))
    others = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return others.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """node, root: every node of the edges (u, v) with the smallest node it is connected to.

    Each round is written to the shared folder, and so is what a round joins its edges with:
    the join then shuffles both sides for itself, and a node with very many edges can be split.
    Nodes without an edge to another don't appear.
    """
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    held = stored(down)
    mark = _mark(held)
    while True:
        held = stored(_small_star(_large_star(held)).distinct())
        new = _mark(held)
        if new == mark:
            roots = held.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return held.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
        mark = new
