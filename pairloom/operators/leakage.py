"""How much like sequences of different splits are: an audit of any split, by a similarity join whose copies are counted, not paired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.cluster import similar_pairs
from pairloom.operators.keys import saved


def similar_across(seqs: DataFrame, placed: DataFrame, identity: float = 0.4, coverage: float = 0.8) -> DataFrame:
    """(split_a, split_b, pairs), split_a <= split_b: pairs of members whose sequences reach identity and coverage of both.

    seqs (id, seq), placed (id, split); a member is an id in a split, so an id in two splits is like
    itself across them.  Members with equal sequences are counted by sequence and split, so
    neither they nor the pairs between them are written out.  Empty and null sequences are like none.
    """
    members = saved(seqs.filter("seq <> ''").join(placed.select("id", "split").distinct(), "id").groupBy("seq", "split").agg(F.min("id").alias("id"), F.count("*").alias("n")))
    texts = saved(members.groupBy("seq").agg(F.min("id").alias("id")))
    of = texts.join(members.select("seq", "split", "n"), "seq").select("id", "split", "n")
    end = lambda c: of.select(F.col("id").alias(c), F.col("split").alias(f"split_{c}"), F.col("n").alias(f"n_{c}"))
    pairs = similar_pairs(texts, identity, coverage)
    apart = pairs.join(end("a"), "a").join(end("b"), "b").select("split_a", "split_b", (F.col("n_a") * F.col("n_b")).alias("pairs"))
    same = end("a").join(end("b"), F.col("a") == F.col("b")).filter("split_a <= split_b")
    same = same.select("split_a", "split_b", F.when(F.col("split_a") == F.col("split_b"), F.expr("n_a * (n_a - 1) div 2")).otherwise(F.col("n_a") * F.col("n_b")).alias("pairs"))
    both = apart.select(F.least("split_a", "split_b").alias("split_a"), F.greatest("split_a", "split_b").alias("split_b"), "pairs").union(same)
    return both.groupBy("split_a", "split_b").agg(F.sum("pairs").alias("pairs")).filter("pairs > 0")
