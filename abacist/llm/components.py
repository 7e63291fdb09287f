"""Connected components by alternating large and small stars, as shuffled joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from abacist.llm.common import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b")


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("low"))
    linked = edges.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.union(low.select("a", F.col("low").alias("b")))


def _sum(edges: DataFrame) -> tuple:
    return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node reachable.

    Each round shortens the distance to the root; rounds end when every component is a star. No
    node's neighbours are gathered: minima are taken by key and joined back, hubs are split by AQE.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges = store(edges, "edges")
    before = _sum(edges)
    while before[0]:
        edges = store(_small_star(store(_large_star(edges).distinct(), "stars")).distinct(), "stars")
        after = _sum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()
    )
