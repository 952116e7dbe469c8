"""Text sources as typed DataFrames; malformed lines are skipped as stated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.keys import keep_last


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): line numbers rise within a file, as a text file is read by offsets."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") * (1 << 20) + F.monotonically_increasing_id() % (1 << 33)).alias("line_no"), "value")


def parse_pairs(lines: DataFrame) -> DataFrame:
    """(a, b): the first two white-space separated words of each value; lines of fewer are skipped."""
    tokens = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    return lines.filter(F.size(tokens) >= 2).select(tokens[0].alias("a"), tokens[1].alias("b"))


def pair_list(spark: SparkSession, path: str) -> DataFrame:
    return parse_pairs(spark.read.text(path))


def parse_stockholm(lines: DataFrame) -> DataFrame:
    """From lines (file, line_no, value): (pfam_id, name, start_pos, end_pos, sequence, line_no): NAME/START-END SEQUENCE; gaps go, upper case; the file's stem is the domain."""
    fields = F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")
    rows = lines.withColumn("f", fields).filter((~F.startswith(F.trim("value"), F.lit("#"))) & ~F.startswith(F.trim("value"), F.lit("//")) & (F.size("f") == 2))
    place = F.substring_index(F.col("f")[0], "/", -1)
    rows = rows.select("file", "line_no", F.split_part(F.col("f")[0], F.lit("/"), F.lit(1)).alias("name"), place.alias("c"), F.upper(F.translate(F.col("f")[1], "-.", "")).alias("sequence"), F.col("f")[0].contains("/").alias("has"))
    coords = F.regexp_extract("c", r"^(\d+)-(\d+)$", 1), F.regexp_extract("c", r"^(\d+)-(\d+)$", 2)
    stem = F.regexp_extract("file", r"([^/]+?)(\.[A-Za-z]+)*$", 1)
    return rows.filter("has").filter((coords[0] != "") & (F.col("sequence") != "")).select(stem.alias("pfam_id"), "name", coords[0].cast("int").alias("start_pos"), coords[1].cast("int").alias("end_pos"), "sequence", "line_no")


def stockholm(spark: SparkSession, path: str) -> DataFrame:
    return parse_stockholm(numbered(spark, path))


def parse_id_mapping(lines: DataFrame, id_type: str) -> DataFrame:
    """From lines (file, line_no, value): (symbol, uniprot_id) of one id type; the last line of a symbol wins."""
    cells = F.split("value", "\t")
    rows = lines.filter((F.size(cells) >= 3) & (cells[1] == id_type)).select(cells[2].alias("symbol"), cells[0].alias("uniprot_id"), "file", "line_no")
    return keep_last(rows, ["symbol"], "file", "line_no").select("symbol", "uniprot_id")


def id_mapping(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    return parse_id_mapping(numbered(spark, path), id_type)


def fasta(spark: SparkSession, path: str, max_length: int = 0, empty: bool = False) -> DataFrame:
    """(header, accession, sequence), plain or gz; sequences over max_length (0: none) are skipped, and empty ones unless they are wanted."""
    record = F.regexp_replace("value", r"^>|\r", "")
    head = F.substring_index(record, "\n", 1)
    body = F.regexp_replace(F.substring(record, F.length(head) + 2, F.length(record)), r"[ \t\n\f\r]", "")
    rows = spark.read.option("lineSep", "\n>").text(path).select(head.alias("header"), F.when(F.size(F.split(head, r"\|")) > 1, F.split(head, r"\|")[1]).otherwise(F.split(head, " ")[0]).alias("accession"), body.alias("sequence"))
    return rows.filter((F.lit(empty) | (F.length("sequence") > 0)) & ((F.length("sequence") <= max_length) if max_length else F.lit(True)))


def parse_protein_terms(rows: DataFrame) -> DataFrame:
    """(uniprot_id, go_accession): the list column exploded; repeats stay, rows without terms go."""
    return rows.select(F.col("Entry").alias("uniprot_id"), F.explode(F.split("Gene Ontology IDs", "; ")).alias("go_accession"))


def protein_terms(spark: SparkSession, path: str) -> DataFrame:
    return parse_protein_terms(spark.read.csv(path, sep="\t", header=True))


def parse_domain_terms(lines: DataFrame) -> DataFrame:
    """(pfam_id, pfam_name, go_name, go_accession) of lines `Pfam:ID NAME > GO:TERM ; GO:NUMBER`; others are skipped."""
    pattern = r"^Pfam:(\S+) (.*?) > GO:(.*?) ; (GO:.*)$"
    get = lambda i: F.trim(F.regexp_extract("value", pattern, i))
    return lines.filter(F.col("value").rlike(pattern)).select(get(1).alias("pfam_id"), get(2).alias("pfam_name"), get(3).alias("go_name"), get(4).alias("go_accession"))


def domain_terms(spark: SparkSession, path: str) -> DataFrame:
    return parse_domain_terms(spark.read.text(path))


def links(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("protein1 string, protein2 string, combined_score int").csv(path, sep=" ", header=True)


def tested_ppis(spark: SparkSession, path: str) -> DataFrame:
    """(bait, prey, n_tested); an error if a column is missing, the others are not read."""
    df = spark.read.parquet(path)
    missing = {"gene_name_bait", "gene_name_prey", "n_tested"} - set(df.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    return df.select(F.col("gene_name_bait").alias("bait"), F.col("gene_name_prey").alias("prey"), F.col("n_tested").cast("int").alias("n_tested"))


def gene_entries(spark: SparkSession, path: str) -> DataFrame:
    """(accession, primary, synonyms, features) of JSON entries; names are those of the first gene block."""
    schema = "primaryAccession string, genes array<struct<geneName: struct<value: string>, synonyms: array<struct<value: string>>>>, uniProtKBCrossReferences array<struct<`database`: string, id: string>>"
    first = F.get("genes", F.lit(0))
    refs = F.transform(F.filter("uniProtKBCrossReferences", lambda x: x["database"] == "Pfam"), lambda x: x["id"])
    return spark.read.schema(schema).json(path).select(F.col("primaryAccession").alias("accession"), first["geneName"]["value"].alias("primary"), F.transform(first["synonyms"], lambda s: s["value"]).alias("synonyms"), refs.alias("features"))


def parse_clusters(lines: DataFrame) -> DataFrame:
    """From lines (line_no, value): (centroid, member, pos); lines without exactly two cells are skipped."""
    cells = F.split("value", "\t")
    return lines.filter(F.size(cells) == 2).select(cells[0].alias("centroid"), cells[1].alias("member"), F.col("line_no").alias("pos"))


def cluster_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_clusters(numbered(spark, path))


def join_embeddings(*parts: DataFrame) -> DataFrame:
    """All parts in one; an error if a key is in several."""
    import functools

    from pairloom.schema import require_unique

    return require_unique(functools.reduce(DataFrame.unionByName, parts), ["seq_id"])
