"""Connected components of a link table by alternating large and small stars, all in joins and partial sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.session import stage


def _star(edges: DataFrame) -> DataFrame:
    """Each (node, other) with the least of the node and all its others."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return edges.join(least, "a")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, cluster) of every linked node; the cluster is its least node. `links` has a and b, in any order.

    Rounds grow with the logarithm of the longest chain. A hub is a hot join key: its least neighbour is a partial
    minimum and its links are split by the adaptive join. Raises if `most_rounds` rounds do not end it.
    """
    def told(edges: DataFrame) -> tuple:
        return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = stage(links.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = told(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stage(_star(both).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
                      .filter(F.col("a") != F.col("b")).distinct())
        small = _star(large)
        edges = stage(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            small.select("a", F.col("m").alias("b"))).filter(F.col("a") != F.col("b")).distinct())
        now = told(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components are unfinished after {most_rounds} rounds")
    found = edges.groupBy("a").agg(F.min("b").alias("cluster")).withColumnRenamed("a", "node")
    return found.union(found.select("cluster").distinct().select(F.col("cluster").alias("node"), "cluster"))
