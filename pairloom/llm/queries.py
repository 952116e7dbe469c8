"""The queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import decontaminate as decontamination
from pairloom.llm import exact_dedup, fingerprints, importance, jaccard_join, line_dedup, prefix_trie, suffix_dedup, warc
from pairloom.llm import lm_score as lm_score_module
from pairloom.llm.decontaminate import decontaminate, proximity
from pairloom.llm.fingerprints import fingerprint_edits
from pairloom.llm.jaccard_join import jaccard_components
from pairloom.llm.language import declared_in, identify
from pairloom.llm.lm_score import lm_score
from pairloom.llm.packing import pack_documents
from pairloom.llm.quality import score_quality
from pairloom.llm.suffix_dedup import remove_repeats
from pairloom.llm.warc import build_derivatives, plain_text
from pairloom.operators import keys


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    """A null id has the remainder of an empty one, in every query."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % n


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op2_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with a window whose words all stand near each other, in any order."""
    out = proximity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_near", F.sha2(F.array_join("near", ","), 256).alias("near_sha256"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op3_edited_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op3_fingerprints pairs and edits, for which there is SQL."""
    return op3_fingerprints(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").filter(_remainder(4) != 2).select("doc_id", F.col("quality").alias("label"))
    out = score_quality(_table(spark, sf_dir, "documents"), labels)
    return out.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", "predicted")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lm_score(_table(spark, sf_dir, "documents"), _remainder(5) != 1)
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_lm_score_rounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6_lm_score to five places, for which there is SQL."""
    out = op6_lm_score(spark, sf_dir)
    return out.withColumns({c: F.round(c, 5) for c in ("base_score", "score")})


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents declare nothing: their lang is the label that the models are fitted to, no evidence."""
    docs = _table(spark, sf_dir, "documents")
    return identify(docs, docs, F.lit(None), F.col("source")).select("doc_id", "language", "probability", "accepted")


def op7_language_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages by their text, the lang of their html element and their host; the models are fitted to documents."""

    def texts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("page_id", "declared", "host")}, "text": pa.array([None if x is None else plain_text(x) for x in batch.column("html").to_pylist()], pa.string())})

    host = F.regexp_replace(line_dedup.site_of(F.col("url")), r"^.*@|:\d+$", "")
    pages = _table(spark, sf_dir, "pages").select("page_id", declared_in(F.col("html")).alias("declared"), host.alias("host"), "html")
    read = pages.mapInArrow(texts, "page_id long, declared string, host string, text string")
    out = identify(read, _table(spark, sf_dir, "documents"), F.col("declared"), F.col("host"), id_col="page_id")
    return out.select(F.col("doc_id").alias("page_id"), "language", "probability", "accepted")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_derivatives(_table(spark, sf_dir, "pages"))


def op8_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as response records with ids and headers of their own, read back, and the links of the records derived from those."""
    pages = _table(spark, sf_dir, "pages")
    own = F.concat(F.lit("<urn:x-page:"), F.col("page_id").cast("string"), F.lit(">"))
    http = F.create_map(F.lit("Content-Type"), F.lit("text/html; charset=utf-8"), F.lit("Content-Length"), F.octet_length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("X-Page"), F.col("page_id").cast("string"))
    written = warc.write_files(warc.response_records(pages, own, headers=http), keys.fresh_path(spark), "2024-01-01T00:00:00Z")
    back = warc.responses_of(written.filter("record_type = 'response'"), "data").withColumn("page_id", F.element_at("headers", "X-Page").cast("long"))
    out = build_derivatives(back, headers_col="headers", record_col="record_id")
    return out.select("page_id", "record_type", "refers_to", "target_uri", F.element_at("headers", "X-Source-Content-Length").cast("long").alias("source_length"), (F.octet_length("block") == F.col("content_length")).alias("whole"), (F.col("record_id") != F.col("refers_to")).alias("own_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(_table(spark, sf_dir, "documents")).drop("repeats_history")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_packing, op2_decontamination, op2_proximity, op3_fingerprints, op3_edited_texts, op4_line_dedup, op5_quality, op6_lm_score, op6_lm_score_rounded, op7_language, op7_language_pages, op8_warc, op8_warc_records, op9_jaccard_join, op10_suffix_dedup, op11_exact_dedup, op12_importance_resampling, op13_prefix_trie)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": decontamination.SQL, "op3_edited_texts": fingerprints.EDITS_SQL, "op8_warc_records": warc.RECORDS_SQL, "op4_line_dedup": line_dedup.SQL, "op6_lm_score_rounded": lm_score_module.SQL, "op9_jaccard_join": jaccard_join.SQL, "op10_suffix_dedup": suffix_dedup.SQL, "op11_exact_dedup": exact_dedup.SQL, "op12_importance_resampling": importance.SQL, "op13_prefix_trie": prefix_trie.SQL}
