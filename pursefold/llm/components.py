"""Connected components of links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pursefold.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): for every end of a link (a, b) the smallest node that it reaches.

    Alternates large and small stars: each node hands its larger, then its smaller, neighbours to the smallest node that it
    knows. A round is joins and map-side combined minima, and ends as a written table; the number of rounds grows with the
    logarithm of the longest chain. The minima are dealt out by their node already, so they are joined by a struct of it: both
    sides are then shuffled for the join, and adaptive execution can split a hub's links over several tasks.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        # Large star: every larger neighbour of u is linked to the smallest one.
        large = edges.join(low, F.struct("b") == F.struct("u")).select("a", F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        # Small star: so is u itself, and its other smaller neighbours.
        small = large.join(low, F.struct("a") == F.struct("u")).select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a != b").distinct(), "links")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = now
