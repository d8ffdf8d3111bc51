"""Connected components of an edge table, by alternating large-star and small-star steps.

Edges stay in Spark; every step is written to the shared folder, so a lost
executor costs one step.  After O(log n) steps every node points at the least
node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the (u, v) edges; the component is its least node."""
    now = written(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    while True:
        nodes = now.groupBy("u").agg(F.count(F.lit(1)).alias("k"), F.sum("v").alias("v"))
        new = nodes.agg(F.sum("k"), F.max("k"), F.sum("v"), F.sum("u")).first()
        if new[0] is None or (new[1] == 1 and new == state):
            break
        state = new
        now = written(_small_star(_large_star(now)), "edges")
    root = now.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(root).distinct()
