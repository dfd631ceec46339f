"""Connected components of links, by alternating star steps that each shrink every neighbourhood at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of its neighbourhood."""
    near = _both_ways(edges)
    least = near.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("m"))
    return _ordered(near.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.col("b").alias("node"), F.col("a").alias("v"))
    least = down.groupBy(F.col("node").alias("n")).agg(F.min("v").alias("m"))
    linked = down.join(least, F.col("node") == F.col("n"))
    return _ordered(linked.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("n").alias("a"), F.col("m").alias("b"))))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links (a, b): the smallest node that can be reached.

    Neighbourhoods are joined and summed, never gathered, and each step is written before the next.
    """
    spark = links.sparkSession
    edges = cut_lineage(spark, _ordered(links.select("a", "b")), "links")
    before = None
    while True:
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if mark == before:
            break
        before = mark
        edges = cut_lineage(spark, _small_star(_large_star(edges)), "links")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
