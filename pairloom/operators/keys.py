"""Key semantics: first or last writer, surrogate ids, canonical pairs, shards and seeded orders."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def fresh_path(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names.  Where it is unset, in a temporary one on a local master, as in tests; an error on a cluster, whose executors would not see each other's files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="pairloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    own = f"{folder}/tables/{spark.sparkContext.applicationId}"
    if own not in _OWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        _OWN[own] = (path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path)
    return f"{own}/{uuid.uuid4().hex}"


#: Folders of the tables of this process's applications, as Hadoop has them.
_OWN: dict[str, tuple] = {}


@atexit.register
def forget() -> None:
    """Deletes all tables that this process has written to the shared folder.  Runs at its end; call it earlier where no result that reads them is needed any more."""
    while _OWN:
        _, (files, path) = _OWN.popitem()
        with contextlib.suppress(Exception):  # the gateway may be gone already
            files.delete(path, True)


#: Spark's setting by which what a query shuffled goes when the query ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, lean: bool = False) -> DataFrame:
    """df as a table in the shared folder, so that later steps don't compute it again; lean deletes at once what was shuffled for it."""
    spark = df.sparkSession
    path = fresh_path(spark)
    before = spark.conf.get(_CLEANUP)
    if lean:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if lean:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def dropped(*tables: DataFrame | None) -> None:
    """Deletes tables that saved() gave and that nothing reads any more; others are left alone."""
    for df in tables:
        if path := df is not None and df.__dict__.get("_saved_at"):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def keep_first(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row for each key, the first by order, as insert-or-ignore leaves it: aggregated before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """One row for each key, the last by order, as a dictionary that is overwritten leaves it."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def positions(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """df with dense positions from 0 in the given total order, without a window over all rows: ranges are sorted on their own and shifted by the counts of those before.

    The ranges are written before they are counted: their bounds come from a sample, so
    two plans of one ranging need not agree.
    """
    ranged = saved(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    # the upper bits of _at are the range, the lower 33 the place in it
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    sizes = ranged.groupBy("_range").count()
    before = sizes.withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # a row for each range, so its size is bounded by the number of partitions
    placed = ranged.join(F.broadcast(before.select("_range", "_before")), "_range")
    return placed.withColumn(name, (F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")).cast("long")).drop("_at", "_range", "_before")


def surrogate_ids(df: DataFrame, *order: str, name: str = "id") -> DataFrame:
    """df with ids 1..N in the given total order."""
    return positions(df, *order, name=name).withColumn(name, F.col(name) + 1)


def pair(a, b) -> list[Column]:
    """An unordered pair as lo, hi."""
    return [F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")]


def seeded(seed: str, *key) -> Column:
    """A reproducible random order: md5 of seed and key."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in key]))


def contiguous_shards(df: DataFrame, shards: int, *order: str) -> DataFrame:
    """df with shard = pos div ceil(total / min(shards, total))."""
    placed, total = positions(df, *order), df.count()
    chunk = -(-total // max(1, min(shards, total))) if total else 1
    return placed.withColumn("shard", F.expr(f"pos div {chunk}"))


def batches(df: DataFrame, size: int, *order: str) -> DataFrame:
    """Successive rows in batches of size, the last may be shorter: (batch, items)."""
    placed = positions(df.select(*order), *order)
    return placed.groupBy(F.expr(f"pos div {size}").alias("batch")).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", *order))), lambda r: r[order[0]]).alias("items"))


def head_per_shard(df: DataFrame, shard: str, k: int, *order: str) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(shard).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")
