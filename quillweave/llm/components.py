"""Connected components of a link table, without ever gathering a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillweave.llm.common import Scratch


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, m): the lower of u and its lowest neighbour v. A minimum, so it is taken before the shuffle too."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node u has one v and no v is a u: then nothing changes any more."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 OR out > 0 AND into > 0").isEmpty()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of each node of links (a, b) that isn't its component's lowest node.

    Alternates two steps until each component is one star around its lowest node: each node's larger neighbours are hung to
    the lowest node it knows, then its smaller ones and itself. The number of rounds grows with the logarithm of the longest
    path. Every round is a written table.
    """
    edges = scratch.keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.join(_lowest(large), "u").select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        new = scratch.keep(small)
        scratch.drop(edges)
        edges = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
