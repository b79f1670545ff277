"""Connected components on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillsight.session import stage


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node of its component.

    Large-star and small-star steps in turn, each a minimum by node and a join; the edge table, which never grows, is
    written after each round.  A node with very many neighbours is met as one side of a join, which AQE splits.
    """
    edges = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                  "edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        if not now[0]:
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(low, "a").filter(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())
        # Every edge now runs from the larger node to the smaller.
        large = stage(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        edges = stage(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())
