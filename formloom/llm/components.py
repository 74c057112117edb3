"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the least node reachable, for every node of an edge
    ``u, v`` (any order, repeats and loops allowed) that is not its own root.

    Rounds end when the edges no longer change; their number follows the
    logarithm of the longest chain.  Each round is written to the shared
    folder.  Nodes are long; an empty table gives an empty table.
    """
    now = written(edges.where("u != v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        then = written(_small_star(_large_star(now)), "edges")
        row = then.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        drop_written(now)
        now = then
        if tuple(row) == state or not row[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = tuple(row)
