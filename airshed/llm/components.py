"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airshed.llm.common import written


def _star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both directions of the edges and, per node, the smallest of itself and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    least = (both.groupBy("a").agg(F.min("b").alias("m"))
             .select(F.col("a").alias("u"), F.least("a", "m").alias("m")))
    return both, least


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> one row per node: node, root (the smallest node of its component).

    Every round links the neighbours of each node to the smallest of them: first those above the
    node, then those below. It ends when the edges are stars, after a number of rounds that grows
    with the logarithm of the component's size. Minima are combined before the shuffle, and the
    join that follows can be split, so a node with very many links is no hot group.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                                 F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both, least = _star(edges)
        large = (both.where("b > a").join(least, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = written(large, "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        small = (large.where("b < a").join(least, F.col("a") == F.col("u"))
                 .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                           F.struct("a", F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b").distinct())
        edges = written(small, "small")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
                    .first())
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select("b", "b").distinct())
