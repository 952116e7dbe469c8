"""Degrees, endpoints, cluster graphs and cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def half_edges(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """A row (node, ...) for each end of each edge; a self loop gives two."""
    rest = [c for c in edges.columns if c not in (a, b)]
    return edges.select(F.explode(F.array(a, b)).alias("node"), *rest)


def endpoints(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    return half_edges(edges, a, b).select("node").filter("node is not null").distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """(node, pos, neg) from edges (a, b, negative)."""
    return half_edges(edges).groupBy("node").agg(F.count_if(~F.col("negative")).alias("pos"), F.count_if("negative").alias("neg"))


def reversed_conflicts(edges: DataFrame) -> DataFrame:
    """Pairs stored in both directions with different labels, once each, with the label of the rising one: one aggregation, no self join."""
    rows = edges.filter("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    both = rows.agg(F.max(F.when(F.col("a") < F.col("b"), F.col("negative"))).alias("negative"), F.max(F.when(F.col("a") > F.col("b"), F.col("negative"))).alias("other"))
    return both.filter("negative <> other").select("a", "b", "negative")


def cluster_of(members: DataFrame, assignment: str = "last") -> DataFrame:
    """(domain, cluster) from (centroid, member, pos): the last line of a domain wins, or the cluster with most of its members."""
    part = lambda c: F.split_part(F.col(c), F.lit("-"), F.lit(1)).cast("long")
    rows = members.select(part("member").alias("domain"), part("centroid").alias("cluster"), "pos")
    if assignment == "last":
        return rows.groupBy("domain").agg(F.max_by("cluster", "pos").alias("cluster"))
    votes = rows.groupBy("domain", "cluster").agg(F.count("*").alias("n"))
    return votes.groupBy("domain").agg(F.max_by("cluster", F.struct("n", -F.col("cluster"))).alias("cluster"))


def on_clusters(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """edges with ca and cb; a node without a cluster is its own."""
    for end in ("a", "b"):
        edges = edges.join(clusters.select(F.col("domain").alias(end), F.col("cluster").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    return edges


def cluster_graph(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """(src, dst, w): distinct edges between each unordered pair of clusters, the diagonal included."""
    return on_clusters(edges, clusters).groupBy(F.least("ca", "cb").alias("src"), F.greatest("ca", "cb").alias("dst")).agg(F.count_distinct("id").alias("w"))


def cluster_weights(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster").agg(F.count_distinct("domain").alias("w"))


def cut(graph: DataFrame, parts: DataFrame) -> DataFrame:
    """(internal, cut) weights of a cluster graph under parts (cluster, part)."""
    end = lambda e, p: parts.select(F.col("cluster").alias(e), F.col("part").alias(p))
    return graph.join(end("src", "pa"), "src").join(end("dst", "pb"), "dst").agg(
        F.coalesce(F.sum(F.when(F.col("pa") == F.col("pb"), F.col("w"))), F.lit(0)).alias("internal"), F.coalesce(F.sum(F.when(F.col("pa") != F.col("pb"), F.col("w"))), F.lit(0)).alias("cut")
    )


def split_edges(edges: DataFrame, clusters: DataFrame, parts: DataFrame) -> DataFrame:
    """(id, split) of the edges whose clusters share a part; the others are dropped."""
    end = lambda e, p: parts.select(F.col("cluster").alias(e), F.col("part").alias(p))
    placed = on_clusters(edges, clusters).join(end("ca", "pa"), "ca").join(end("cb", "pb"), "cb")
    return placed.filter("pa = pb").select("id", F.col("pa").alias("split"))
