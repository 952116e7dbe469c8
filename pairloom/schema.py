"""Tables of the interaction database."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed column names and types of the seven tables.
TABLES = {
    "domain": "id long, pfam_id string, name string",
    "domain_go_terms": "domain_id long, go_accession string",
    "ddi": "id long, domain_id_a long, domain_id_b long, negative boolean, source string",
    "protein": "id long, uniprot_id string, sequence string, prott5_per_residue array<array<float>>, esm3_per_residue array<array<float>>, esmc_per_residue array<array<float>>",
    "protein_go_terms": "protein_id long, go_accession string",
    "ppi": "protein_id_a long, protein_id_b long, score int",
    "domain_protein_map": "domain_id long, protein_id long, domain_sequence string, start_pos int, end_pos int, esm3_per_domain array<float>, esmc_per_domain array<float>",
}

#: Columns whose values (null apart) must be unique in each table.
UNIQUE = {
    "domain": [["id"], ["pfam_id"]], "ddi": [["id"], ["domain_id_a", "domain_id_b"]], "protein": [["id"], ["uniprot_id"]],
    "ppi": [["protein_id_a", "protein_id_b"]], "domain_protein_map": [["domain_id", "protein_id"]],
}


#: References (child, column, parent): a row goes with the row that it refers to.
FOREIGN = (
    ("ddi", "domain_id_a", "domain"), ("ddi", "domain_id_b", "domain"), ("domain_go_terms", "domain_id", "domain"), ("domain_protein_map", "domain_id", "domain"), ("domain_protein_map", "protein_id", "protein"),
    ("protein_go_terms", "protein_id", "protein"), ("ppi", "protein_id_a", "protein"), ("ppi", "protein_id_b", "protein"),
)


@dataclass(frozen=True)
class Database:
    """Immutable: each step returns another one."""

    domain: DataFrame
    domain_go_terms: DataFrame
    ddi: DataFrame
    protein: DataFrame
    protein_go_terms: DataFrame
    ppi: DataFrame
    domain_protein_map: DataFrame
    notes: dict = field(default_factory=dict)

    def with_(self, **tables: DataFrame) -> Database:
        return replace(self, **tables)

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name != "notes"}

    def write(self, path: str) -> None:
        for name, df in self.tables().items():
            df.write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Database:
        return cls(**{name: spark.read.schema(kind).parquet(f"{path}/{name}") for name, kind in TABLES.items()})


def empty_database(spark: SparkSession) -> Database:
    return Database(**{name: spark.createDataFrame([], kind) for name, kind in TABLES.items()})


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values on more than one row; rows with a null key never clash."""
    return df.dropna(subset=keys).groupBy(*keys).count().filter("count > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """df, or an error if a key repeats: what a plain insert does."""
    clash = duplicates(df, keys).take(1)
    if clash:
        raise ValueError(f"{keys} repeats: {clash[0]}")
    return df


def check(db: Database, repeats: bool = False) -> None:
    """An error where a unique value repeats or a reference has no row; with repeats only ids must be unique, as stored names may be shared."""
    for name, rules in UNIQUE.items():
        for keys in rules if not repeats else [["id"]] if ["id"] in rules else []:
            require_unique(getattr(db, name), keys)
    for table, column, parent in FOREIGN:
        lost = getattr(db, table).filter(F.col(column).isNotNull()).join(getattr(db, parent).select(F.col("id").alias(column)), column, "left_anti").take(1)
        if lost:
            raise ValueError(f"{table}.{column} has no {parent}: {lost[0]}")
