"""Connected components of a link table, by alternating large-star and
small-star steps.  Every step is an aggregation and a join whose result is
written to the shared folder; nothing is collected but a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_STEPS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over (a, b), a > b: a node's greater neighbours (large star) or
    itself and its smaller ones (small star) are tied to its least neighbour."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.withColumn("m", F.least("a", "m"))
    linked = both.join(least, "a")
    out = linked.filter(F.col("b") > F.col("a") if large else F.col("b") != F.col("m"))
    out = out.select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        out = out.unionByName(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node reachable from each node of the links
    (a, b) but itself the least; nodes without a row are components of their own."""
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.filter("a <> b").distinct(), "edges")
    for _ in range(MAX_STEPS):
        edges = written(_star(_star(edges, True), False), "edges")
        # done once every node has one link, to a node that has none
        nodes = edges.groupBy("a").count().withColumnRenamed("a", "node")
        again = nodes.filter("count > 1").select("node").unionByName(
            edges.select(F.col("b").alias("node")).distinct().join(nodes, "node", "left_semi"))
        if again.isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    raise RuntimeError(f"components did not settle in {MAX_STEPS} steps")
