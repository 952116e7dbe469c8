"""Stored snapshots of tables, and keyed merges into them: old rows keep their ids, the first writer of a key wins, new ids go on.

A commit writes every changed table to a folder of its own and only then a manifest, a small file
that names the folder of each table.  The manifest with the highest number is the snapshot, so a
run that dies leaves the one before, and readers see all tables of one commit.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.keys import keep_first, positions, saved


class Snapshots:
    """Commits under a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def number(self) -> int:
        """Of the last commit; 0 if there is none."""
        fs, folder = self._file("manifests")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def manifest(self) -> dict[str, dict]:
        """Folder and schema of each table."""
        number = self.number()
        return json.loads(self.spark.read.text(f"{self.root}/manifests/{number:09d}.json", wholetext=True).first().value) if number else {}

    def read(self, name: str) -> DataFrame | None:
        about = self.manifest().get(name)
        return self.spark.read.schema(about["schema"]).parquet(f"{self.root}/{about['folder']}") if about else None

    def commit(self, **tables: DataFrame) -> int:
        """Writes tables, and a manifest in which the others stay as they are.  An error if another run committed meanwhile; its commit stays, and what was written here is never read."""
        base, now = self.number(), self.manifest()
        for name, df in tables.items():
            now[name] = {"folder": f"{name}/{uuid.uuid4().hex}", "schema": ", ".join(f"`{c}` {t}" for c, t in df.dtypes)}
            df.write.parquet(f"{self.root}/{now[name]['folder']}")
        number = base + 1
        fs, draft = self._file(f"manifests/_{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(now, sort_keys=True).encode()))
        out.close()
        final = self._file(f"manifests/{number:09d}.json")[1]
        if self.number() != base or fs.exists(final) or not fs.rename(draft, final):
            raise RuntimeError(f"commit {number} of {self.root} was made by another run")
        return number


def merged(old: DataFrame | None, rows: DataFrame, keys: list[str], order: list[str], id_col: str = "id") -> DataFrame:
    """old with the rows of new keys, the first of each key by order; their ids go on after the largest, by order and key.

    order names columns of rows that are not kept.  Rows whose key old has are ignored.
    """
    first = keep_first(rows, keys, *[F.col(c) for c in order], *[F.col(c) for c in rows.columns if c not in (*keys, *order)])
    if old is not None:
        first = first.join(old.select(*keys), keys, "left_anti")
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0] if old is not None else 0
    placed = positions(first, *order, *keys, name=id_col).withColumn(id_col, F.col(id_col) + top + 1)
    columns = [id_col, *[c for c in rows.columns if c not in order]]
    return placed.select(*columns) if old is None else old.select(*columns).unionByName(placed.select(*columns))


def ingest_pairs(store: Snapshots, pairs: DataFrame) -> int:
    """Merges named pairs (a, b, negative, source, p) and the names at their ends into the tables domain (id, name) and ddi (id, a, b, negative, source), in one commit.  p is the priority within the pairs: the smallest of a pair wins, but none over an earlier commit."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct().withColumn("p", F.lit(0))
    domain = saved(merged(store.read("domain"), ends, ["name"], ["p"]))
    end = lambda c: domain.select(F.col("name").alias(c), F.col("id").alias(f"id_{c}"))
    rows = pairs.join(end("a"), "a").join(end("b"), "b").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"), "negative", "source", "p")
    return store.commit(domain=domain, ddi=saved(merged(store.read("ddi"), rows, ["a", "b"], ["p"])))
