"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); component is the smallest node reachable.

    Self loops, repeated and reversed edges are harmless; rows with a null end are ignored.
    Each round joins edges with a minimum for each node, so that no node's neighbours are
    gathered; rounds grow with the logarithm of the longest path, and each is written to
    the shared folder.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = stored(now)
    sign = _sign(now)
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        now = stored(small.distinct())
        last, sign = sign, _sign(now)
        if sign == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def _sign(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
