"""A corpus pipeline: each stage works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.decontaminate import decontaminate
from pairloom.llm.jaccard_join import jaccard_components
from pairloom.llm.language import identify
from pairloom.llm.line_dedup import dedup_lines
from pairloom.llm.packing import pack_documents
from pairloom.llm.shared import sized_join, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is accepted, and puts it in lang; the models are fitted to the documents' own lang, which is no evidence for them.

    Null and empty texts have nothing but their source's prior; null and repeated ids and repeated rows fare by their texts.
    """
    rows = docs.select(*COLUMNS)
    found = identify(rows, rows, F.lit(None), F.col("source"), carried=F.col("lang"))
    key = F.xxhash64("doc_id", "tag", "carried").alias("_key")
    # all other rows stay as they are
    changed = stored(found.filter(~F.col("accepted") | ~F.col("language").eqNullSafe(F.col("carried"))).select(key, F.col("language").alias("_found"), "accepted").dropDuplicates(["_key"]))
    joined = sized_join(rows.withColumn("_key", F.xxhash64("doc_id", F.xxhash64("text"), "lang")), changed, "_key")
    return joined.filter(F.coalesce("accepted", F.lit(True))).withColumn("lang", F.coalesce("_found", "lang")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the boilerplate lines of each source from the texts; every row stays, a null text stays null."""
    return dedup_lines(docs.select(*COLUMNS)).withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with _key of id and text: rows of one null or repeated id differ by their texts, and rows that share both fare alike."""
    return docs.select(*COLUMNS).withColumn("_key", F.xxhash64("doc_id", "text"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates the document with the smallest id, null ids last.

    Rows of one id and one text are one document and stay once.  Documents without words
    have no near duplicates.  Rows of one id with different texts are different documents.
    """
    rows = _keyed(docs)
    found = stored(jaccard_components(rows.select(F.col("_key").alias("doc_id"), "text")).select(F.col("doc_id").alias("_key"), "component_id").distinct())
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    firsts = rows.select("_key", "doc_id").join(found, "_key").groupBy("component_id").agg(F.min_by("_key", order).alias("_key"))
    kept = rows.join(firsts.select("_key"), "_key", "left_semi")
    return kept.dropDuplicates(["doc_id", "text"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which a benchmark window occurs; rows of one id with other texts, and null texts, stay."""
    rows = _keyed(docs)
    found = decontaminate(rows.select(F.col("_key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    found = stored(found)
    return rows.join(found, "_key", "left_anti").select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences, a row for each piece; every row is packed, null texts as empty ones."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Packing and near duplicates can't be put in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
