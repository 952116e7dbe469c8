"""Tables in the cluster's shared folder, blocks of documents, and the block exchange.

The block exchange counts features (n-grams, shingles, anchors) over the whole corpus
without a row for each: documents are dealt to blocks, each block sends its
sorted distinct feature hashes in a few binary rows, one for each hash range; a range
adds the counts up and answers each block with totals in the order in which it asked.
A feature that a third of all documents hold thus makes one entry a block.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.operators import keys

#: Bytes of text in a block, and of text behind a hash range.
BLOCK_BYTES = 12 << 20
RANGE_BYTES = 8 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 2000

_SQUEEZE = pa.Codec("zstd", compression_level=1)


def stored(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it again: cuts the lineage, survives lost executors, and lets earlier shuffle files go.  dropped() deletes it, and what is left goes at the end of the process."""
    spark = df.sparkSession
    path = keys.fresh_path(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of stored() that no later step reads."""
    for df in tables:
        jvm, spark = df.sparkSession._jvm, df.sparkSession
        path = jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def settled(spark: SparkSession) -> None:
    """Session settings that the operators rely on: shuffle files go when a query ends, and Arrow batches hold at most BATCH_ROWS rows (fewer, if the session says so)."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def n_blocks(spark: SparkSession, total: int, each: int = BLOCK_BYTES) -> int:
    return max(2 * spark.sparkContext.defaultParallelism, -(-total // each))


def in_blocks(docs: DataFrame, blocks: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, doc_id, text): a row's block depends on its id and text, so neither null ids nor a frequent id gather in one."""
    return docs.select(F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)).cast("int").alias("block"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def ids_of(table: pa.Table) -> np.ndarray:
    """doc_id as int64; null counts as the largest."""
    return table.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False).astype(np.int64)


def pack_rising(h: np.ndarray) -> bytes:
    """Rising 64-bit hashes as their steps, byte plane by byte plane: the upper planes of small steps are nearly all zero."""
    steps = np.diff(h, prepend=np.uint64(0))
    return _SQUEEZE.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), asbytes=True)


def unpack_rising(data, n: int) -> np.ndarray:
    planes = np.frombuffer(_SQUEEZE.decompress(data, 8 * n), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> tuple[int, bytes]:
    """Bytes a count, and counts in the narrowest kind that holds them."""
    top = int(counts.max(initial=0))
    kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(k).max)
    return np.dtype(kind).itemsize, _SQUEEZE.compress(counts.astype(kind).tobytes(), asbytes=True)


def unpack_counts(data, wide: int, n: int) -> np.ndarray:
    return np.frombuffer(_SQUEEZE.decompress(data, wide * n), f"<u{wide}").astype(np.int64)


ASKED = "bucket int, block int, n int, hashes binary, wide int, counts binary"
TOLD = "block int, bucket int, wide int, n int, totals binary"


def ask(hashes: np.ndarray, counts: np.ndarray, block: int, ranges: int) -> pa.Table:
    """Rows (bucket, block, n, hashes, wide, counts) of one block's sorted distinct hashes."""
    edges = np.append(np.searchsorted(hashes, bucket_starts(ranges)), len(hashes))
    full = np.flatnonzero(edges[1:] > edges[:-1])
    parts = [(hashes[edges[i] : edges[i + 1]], pack_counts(counts[edges[i] : edges[i + 1]])) for i in full]
    return pa.table({
        "bucket": pa.array(full, pa.int32()), "block": pa.array(np.full(len(full), block), pa.int32()), "n": pa.array([len(h) for h, _ in parts], pa.int32()),
        "hashes": pa.array([pack_rising(h) for h, _ in parts], pa.binary()), "wide": pa.array([c[0] for _, c in parts], pa.int32()), "counts": pa.array([c[1] for _, c in parts], pa.binary()),
    })


def bucket_starts(ranges: int) -> np.ndarray:
    """The least hash of each hash range."""
    return np.array([-(-(i << 32) // ranges) << 32 for i in range(ranges)], np.uint64)


def bucket_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range, from the upper 32 bits; rises with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def totals_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of one range's rows: the distinct hashes, their totals, and each row's totals in its order."""
    sizes, wides = table.column("n").to_pylist(), table.column("wide").to_pylist()
    hashes = np.concatenate([unpack_rising(x.as_buffer(), n) for x, n in zip(table.column("hashes"), sizes, strict=True)])
    counts = np.concatenate([unpack_counts(x.as_buffer(), w, n) for x, w, n in zip(table.column("counts"), wides, sizes, strict=True)])
    names, _, which = scan.classes(hashes)
    totals = np.bincount(which, counts, minlength=len(names)).astype(np.int64)
    return names, totals, np.split(totals[which], np.cumsum(sizes)[:-1])


def told(table: pa.Table, parts: list[np.ndarray]) -> dict:
    """The columns of TOLD: one row for each row of the request."""
    packed = [pack_counts(p) for p in parts]
    return {
        "block": table.column("block"), "bucket": table.column("bucket"), "wide": pa.array([w for w, _ in packed], pa.int32()),
        "n": table.column("n"), "totals": pa.array([x for _, x in packed], pa.binary()),
    }


def _add_up(table: pa.Table) -> pa.Table:
    scan.trim()
    return pa.table(told(table, totals_of(table)[2]))


def spread(df: DataFrame, key: str, groups: int) -> DataFrame:
    """df dealt out by key to as many tasks as there are groups, whatever spark.sql.shuffle.partitions is."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, groups), key)


def exchange(docs: DataFrame, blocks: int, ranges: int, features: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Stored rows of totals by block for the features that each block asked for; see answers()."""

    def request(key, table: pa.Table) -> pa.Table:
        scan.trim()
        return ask(*features(table), key[0].as_py(), ranges)

    asked = spread(docs, "block", blocks).groupBy("block").applyInArrow(lambda key, table: request(key, table), ASKED)
    return stored(spread(asked, "bucket", ranges).groupBy("bucket").applyInArrow(_add_up, TOLD))


def answers(table: pa.Table) -> np.ndarray:
    """The totals of one block, in the order of its sorted distinct hashes."""
    table = table.sort_by("bucket")
    found = [unpack_counts(x.as_buffer(), w, n) for x, w, n in zip(table.column("totals"), table.column("wide").to_pylist(), table.column("n").to_pylist(), strict=True)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "left", row_bytes: int = 64, limit: int = 8 << 20) -> DataFrame:
    """Joins a stored right side: broadcast when its counted rows stay under limit bytes, else by a shuffle whose skewed keys AQE splits."""
    small = right.count() * row_bytes <= limit
    return left.join(F.broadcast(right) if small else right, on, how)
