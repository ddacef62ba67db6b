"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b), component being the smallest node reachable.

    Each round is written to shared storage.  Rounds end when every node hangs directly on its root; a hub
    with very many edges is only a skewed join key.  Loops and repeated edges are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stage(edges, "edges")
    while True:
        degree = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
        inner = edges.select(F.col("b").alias("a")).join(edges.select("a"), "a", "left_semi")
        if degree.union(inner).isEmpty():
            break
        edges = stage(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.toDF("node", "component").union(roots.select("node", "node"))
