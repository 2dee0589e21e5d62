"""Connected components of a graph stored as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edugauge.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest node around: larger ones (large star), or smaller ones and the node itself."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def _unfinished(edges: DataFrame) -> bool:
    """Whether a node has several smaller neighbours, or smaller and larger ones: edges ``u > v`` without such a node are stars."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    met = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not met.filter("down > 1 or (down = 1 and up = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for all nodes of ``edges (a, b)``, by alternating stars.

    Edges are rewritten until they form stars, in a number of rounds that grows with the logarithm of the graph. No step needs the
    edges of a node in one place, and each round is a stored table.
    """
    current = edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = store(current, "edges")
    while _unfinished(current):
        current = store(_star(store(_star(current, True).distinct(), "large_star"), False).distinct(), "small_star")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
