"""Connected components over an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import heavy_keys, spread_join, stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of any orderable type -> (node, root), root the least node of its component.

    Neighbour minima are aggregated before they are joined, and the edges of a node with very many
    neighbours are dealt out to many tasks. Each round is written to the shared folder. The number
    of rounds grows with the logarithm of the component size.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    n, seen = edges.count(), None
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).select("a", F.least("a", "m").alias("m"), "n"), "neighbours")
        heavy = heavy_keys(least, "a", "n", 2 * n)
        large = spread_join(both.where("b > a"), least.select("a", "m"), "a", heavy, F.xxhash64("b")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        n = now[0]
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
