"""Sinks: FASTA, CSV, JSON and partitioned tables."""

from __future__ import annotations

import functools
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fasta_records(df: DataFrame, header, sequence: str) -> DataFrame:
    return df.select(F.concat(F.lit(">"), header, F.lit("\n"), F.col(sequence)).alias("value"))


def write_fasta(df: DataFrame, header, sequence: str, path: str, shard: str | None = None) -> None:
    """gz text, one folder for each shard if one is named; a line of a sequence that would begin a record gets a blank before it, which readers drop."""
    keep = [F.col(shard)] if shard else []
    rows = df.select(F.concat(F.lit(">"), header, F.lit("\n"), F.regexp_replace(sequence, r"(^|\n)>", "$1 >")).alias("value"), *keep)
    writer = rows.write.mode("overwrite").option("compression", "gzip")
    (writer.partitionBy(shard) if shard else writer).text(path)


def domain_header():
    """pfam_uniprot_start_end."""
    return F.concat_ws("_", "pfam_id", "uniprot_id", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"))


def write_map(df: DataFrame, path: str) -> None:
    df.select("pfam_id", "uniprot_id", "start_pos", "end_pos", "sequence").write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


def write_features(features: DataFrame, path: str) -> None:
    """(accession, features) as one JSON map of sorted lists in lines that concatenate to it: an opening brace, an entry a line, a closing brace."""
    entry = F.concat(F.to_json(F.struct("accession")), F.lit("\0"), F.to_json(F.struct(F.sort_array("features").alias("features"))))
    # {"accession":"x"} and {"features":[..]} become "x":[..]
    value = F.regexp_replace(entry, r'^\{"accession":(.*)\}\x00\{"features":(.*)\}$', "$1:$2")
    rows = features.filter("accession is not null and features is not null").select(F.col("accession").alias("k"), value.alias("value"))
    last = rows.agg(F.max("k")).first()[0]
    lines = rows.select("k", F.lit(1).alias("part"), F.concat("value", F.when(F.col("k") == F.lit(last), "").otherwise(",")).alias("value"))
    ends = rows.sparkSession.createDataFrame([("", 0, "{"), ("", 2, "}")], "k string, part int, value string")
    lines.union(ends).orderBy("part", "k").select("value").write.mode("overwrite").text(path)


def write_splits(tables: dict[str, DataFrame], method: str, path: str) -> None:
    """Every table partitioned by method and split."""
    for name, df in tables.items():
        df.withColumn("method", F.lit(method)).write.mode("overwrite").partitionBy("method", "split").parquet(f"{path}/{name}")


def bias_json(report: DataFrame) -> DataFrame:
    return report.select(F.to_json(F.struct("*")).alias("value"))


def bias_text(report: DataFrame, hubs: int = 5) -> str:
    """A short text from the one-row report."""
    row = json.loads(bias_json(report).first().value)
    lines = [f"{k}: {v}" for k, v in row.items() if k != "top"]
    lines += [f"hub {h['node']} ({h['pfam_id']}): {h['pos']} positive, {h['neg']} negative" for h in row.get("top", [])[:hubs]]
    return "\n".join(lines)


def publish_path(root: str, process: str) -> str:
    """Where the outputs of a process go: the first part of its own name, in lower case."""
    return f"{root}/{process.split(':')[-1].split('_')[0].lower()}"


def versions(spark: SparkSession, process: str, /, **tools: str) -> DataFrame:
    """(process, tool, version) of a run, for versions_of()."""
    return spark.createDataFrame([(process, k, v) for k, v in sorted(tools.items())], "process string, tool string, version string")


def versions_of(*runs: DataFrame) -> DataFrame:
    """All runs' versions, each once, by process."""
    return functools.reduce(DataFrame.unionByName, runs).distinct().groupBy("process").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("tool", "version")))).alias("versions"))
