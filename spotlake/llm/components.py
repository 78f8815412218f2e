"""Connected components of a graph given as rows, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from spotlake.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang the greater neighbours of every node on the smallest of its neighbours and itself.

    Only minima are gathered, never the neighbours of a node.
    """
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(edges.select("b", "a"))
    least = ends.groupBy("node").agg(F.min("other").alias("least")).withColumn("least", F.least("node", "least"))
    return edges.join(least, edges["b"] == least["node"]).select("a", F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang every node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select("least", F.explode(F.array("a", "b")).alias("node"))
    return moved.where("node <> least").select(F.col("node").alias("a"), F.col("least").alias("b")).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and none that others hang on hangs on a third."""
    nodes = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select("b", F.lit(0), F.lit(1)))
    return nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).agg(
        F.count_if(F.col("up") + F.col("down") > 1)).collect()[0][0] == 0


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id reachable) of every node of ``edges`` (a, b).

    ``edges`` are read twice, so they should be stored rows. Each round of a large and a small
    star shortens all paths by about half; the loop ends when only stars are left, and takes no
    round where there are only stars from the start. One number a round reaches the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b"))
    while not _are_stars(edges):
        edges = cut(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
