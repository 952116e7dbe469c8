"""Views of the interaction model over the star-schema tables; the SQL twins are in catalogue.py."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.keys import keep_first, saved

LINE_ORDER = ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _gene(suppkey: str) -> Column:
    return F.concat(F.lit("G"), F.col(suppkey) - F.when(F.col(suppkey) % 5 == 0, 1).otherwise(0))


class Analogs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self._edges = spark, sf_dir, None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def domain(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("PF"), F.lpad(F.col("p_partkey").cast("string"), 5, "0")).alias("pfam_id"), F.col("p_name").alias("name"))

    def raw_pairs(self) -> DataFrame:
        """(a, b, bait, prey, n_tested, priority): parts that meet in one order."""
        line = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        x = line.select("l_orderkey", F.col("l_linenumber").alias("i"), F.col("l_partkey").alias("a"), _gene("l_suppkey").alias("bait"), F.col("l_quantity").cast("int").alias("n_tested"))
        y = line.select("l_orderkey", F.col("l_linenumber").alias("j"), F.col("l_partkey").alias("b"), _gene("l_suppkey").alias("prey"))
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("priority"))
        return x.join(y, "l_orderkey").filter("i < j").join(orders, "l_orderkey").select("a", "b", "bait", "prey", "n_tested", "priority")

    def edges(self) -> DataFrame:
        """(id, a, b, negative, source): the first writer of each ordered pair wins; the id is its key."""
        first = self.raw_pairs().groupBy("a", "b").agg(F.min("priority").alias("priority"))
        source = F.when(F.col("priority") == 0, "3did").when(F.col("priority") == 1, "negatome").otherwise("y2h_ms")
        return first.select((F.col("a") * 1_000_000_000 + F.col("b")).alias("id"), "a", "b", (F.col("priority") != 0).alias("negative"), source.alias("source"))

    def stored_edges(self) -> DataFrame:
        """edges(), written once for queries that read them several times."""
        if self._edges is None:
            self._edges = saved(self.edges())
        return self._edges

    def mapped(self) -> DataFrame:
        """(domain, protein, start_pos, sequence): the first line of each pair."""
        return keep_first(self.table("lineitem"), ["l_partkey", "l_suppkey"], *LINE_ORDER).select(F.col("l_partkey").alias("domain"), F.col("l_suppkey").alias("protein"), F.col("l_orderkey").alias("start_pos"))

    def clusters(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("domain"), F.regexp_replace("p_brand", r"\D", "").cast("long").alias("cluster"))

    def genes(self) -> DataFrame:
        """(gene, accession, reviewed) of suppliers; every fifth shares its gene with another."""
        return self.table("supplier").select(_gene("s_suppkey").alias("gene"), F.concat(F.lit("P"), F.col("s_suppkey")).alias("accession"), (F.col("s_acctbal") > 0).alias("reviewed"))

    def features(self) -> DataFrame:
        return self.mapped().select(F.concat(F.lit("P"), "protein").alias("accession"), F.col("domain").alias("feature"))

    def aligned(self) -> DataFrame:
        """mapped() without the smallest parts, which have no alignment."""
        return self.mapped().join(self.table("part").filter("p_size > 7").select(F.col("p_partkey").alias("domain")), "domain", "left_semi")
