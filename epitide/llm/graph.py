"""Connected components by joins: no node list, link list or label table ever passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epitide.sources.stage import settle


def _open(edges: DataFrame) -> bool:
    """Whether some node still has two smaller neighbours, or a smaller and a larger one; else all are stars around their root."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.filter("up > 1 OR up = 1 AND down = 1").agg(F.count("*")).first()[0] > 0


def components(links: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, root) for every node with a link to another: root is the smallest node that can be reached.

    Alternates two steps until only stars are left, which the steps would not change: every node hands its larger neighbours
    to its smallest one, then its smaller neighbours to the smallest. The number of rounds grows with the logarithm of the longest path. A node with
    very many links costs one aggregated row per task and a join that adaptive execution can split. Links from a node
    to itself and repeated links change nothing; null ends are dropped.
    """
    a, b = F.col(src), F.col(dst)
    edges = settle(links.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links")
    while _open(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low).distinct()
        edges = settle(small, "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
