"""Connected components of a graph of any size: large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.sources.scratch import materialise


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another one; ``root`` is the smallest node reachable.

    Null nodes and links of a node with itself are left out. Every step writes the
    edges to the shared folder. The steps end when the edges no longer change, after
    about the logarithm of the longest path. A node with very many neighbours is
    reduced by a map-side minimum, and its join is one that adaptive execution splits.
    """
    edges = links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    edges = materialise(edges, "links")
    before = _digest(edges)
    while before[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialise(
            both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(),
            "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = materialise(
            small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        after = _digest(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
