"""Connected components of links between integer nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm.common import apart, cut


def _with_least(edges: DataFrame) -> DataFrame:
    """(u, v, m): each neighbour of u with the least of u and all its neighbours. The least comes from a partial
    aggregate, and joins the edges of u as one row, so that a node with very many links is split by the skew join."""
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(apart(least, "u"), "u")


def _stars(edges: DataFrame) -> bool:
    """Whether every u has one v, and no v is a u: then nothing is left to join."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("out"), F.lit(0).alias("in")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("out"), F.lit(1).alias("in"))
    )
    seen = ends.groupBy("n").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return seen.filter("out > 1 or out = 1 and in = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (a, b); root is the least node that it reaches.

    Alternating large-star and small-star steps; each round is written before the next, until only stars are left.
    """
    edges = cut(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        seen = _with_least(large)
        small = seen.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(seen.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
