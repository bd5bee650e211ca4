"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneframe.session import settle


def _stars(edges: DataFrame) -> DataFrame:
    """(a, b, m): each edge from both of its ends, m the least of a and a's neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of the edges (a, b) the least node it is connected with.

    Nulls and loops are left out; an edge may be given twice or from either end. A star
    around a hub is one join, whose hub Spark can split; the number of rounds grows with
    the logarithm of the longest path.
    """
    edges = settle(edges.select("a", "b").filter("a <> b").distinct())
    seen = None
    while True:
        large = _stars(edges).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        s = _stars_down(large)
        edges = settle(s)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    ends = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionByName(roots.join(ends, "node", "left_anti"))


def _stars_down(edges: DataFrame) -> DataFrame:
    """Small stars: each node and its lesser neighbours tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
