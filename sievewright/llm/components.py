"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: every node hangs on one smaller node, which hangs on none."""
    inner = edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
    if not inner.isEmpty():
        return False
    return edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component): every node of a link with the smallest node it can reach, except
    nodes that are their own smallest. Each round hooks all neighbours of a node to the smallest
    one, until the edges are stars. Tables between rounds lie in the shared folder."""
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    while not _settled(edges):
        # every node to larger neighbours' smallest one; then every node to its smallest one
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(lowest, "u")
        small = hooked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = stored(small, "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
