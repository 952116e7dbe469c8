"""Exact deduplication against a minimal perfect hash over the distinct digests of earlier documents.

An index of history has a row for each bucket of digests.  A row's minimal perfect hash sends the
bucket's n digests to the slots 0 to n - 1 without a gap: on each level the digests that are
alone at their place set its bit, the others go to the next level, and a slot is the number of
bits set before a digest's own.  A slot holds the whole digest and the locator of the winner (its
id and its place in the table of digests).  Any digest at all may come to a slot, so a lookup
compares all 32 bytes: equal ones are repeats of that winner, the rest are nonmembers, which
are grouped among themselves.

Repeats within a batch are summed up before they are shuffled, so a text that a third of all
documents have is one row for each task; what goes back to the documents is joined by digest,
where Spark splits skewed keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import dropped, spread, stored

#: Digests of a bucket, and buckets for each core at least.
BUCKET, EACH = 50_000, 16
#: Places on a level for each digest that is left.
ROOM = 1.5

INDEX = "bucket int, levels array<int>, bits binary, digests binary, ids array<bigint>, places array<bigint>, sizes array<bigint>"
#: One digest: its winner's id and place, the rows that have it, and whether the winner is of the history.
VERDICT = "digest binary, keep_id bigint, keep_place bigint, group_size bigint, repeats_history boolean"


def normalised(text: str = "text") -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows (digest, doc_id, place); place is unique, so that rows of one id and text can be told apart."""
    return stored(docs.select(F.unhex(F.sha2(normalised(text_col), 256)).alias("digest"), F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("place")))


def winners(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_place, n): the row with the smallest id of each digest, null last, then the first place."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "place")).alias("w")
    return rows.groupBy("digest").agg(first, F.count("*").alias("n")).select("digest", F.col("w.doc_id").alias("keep_id"), F.col("w.place").alias("keep_place"), "n")


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Places of digests, as rows of four words, on a level."""
    h = np.full(len(words), level + 1, np.uint64)
    for k in range(words.shape[1]):
        h = scan.mix(h * np.uint64(0x9E3779B97F4A7C15) + words[:, k])
    return (h % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels, and their bits one after the other, for distinct digests."""
    sizes, bits, left = [], [], words
    while len(left):
        size = int(ROOM * len(left)) + 8
        at = _places(left, len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        left = left[~alone[at]]
    return sizes, np.concatenate(bits) if bits else np.zeros(0, bool)


def slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 if no level has a bit for it.  A digest that was not hashed can come to a slot too."""
    before = np.cumsum(bits) - 1
    out, left, begin = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = begin + _places(words[left], level, size)
        hit = bits[at]
        out[left[hit]] = before[at[hit]]
        left, begin = left[~hit], begin + size
    return out


def _words(column: pa.ChunkedArray) -> np.ndarray:
    """Digests of 32 bytes as rows of four words."""
    flat = column.combine_chunks()
    flat = flat if isinstance(flat, pa.Array) else pa.concat_arrays(flat.chunks)
    return np.frombuffer(b"".join(flat.to_pylist()), "<u8").reshape(-1, 4)


def _build(key, table: pa.Table) -> pa.Table:
    words = _words(table.column("digest"))
    sizes, bits = perfect_hash(words)
    order = np.argsort(slots(words, sizes, bits))
    table = table.take(pa.array(order))
    return pa.table({
        "bucket": pa.array([key[0].as_py()], pa.int32()), "levels": pa.array([sizes], pa.list_(pa.int32())), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary()), "digests": pa.array([words[order].tobytes()], pa.binary()),
        **{name: pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for name, c in (("ids", "keep_id"), ("places", "keep_place"), ("sizes", "n"))},
    })


def _bucket(buckets: int) -> Column:
    """From the digest's own bits, by four bytes that are not a level's hash."""
    return (F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long") % buckets).cast("int").alias("bucket")


def n_buckets(df: DataFrame, rows: int) -> int:
    return max(EACH * df.sparkSession.sparkContext.defaultParallelism, -(-rows // BUCKET))


def index_of(history: DataFrame, buckets: int) -> DataFrame:
    """The index (INDEX) of distinct digests (digest, keep_id, keep_place, n), a row for each bucket that has any.  It may be kept and given to later batches, with the same number of buckets."""
    return spread(history.withColumn("bucket", _bucket(buckets)), "bucket", buckets).groupBy("bucket").applyInArrow(lambda key, table: _build(key, table), INDEX)


def _look_up(key, fresh: pa.Table, index: pa.Table) -> pa.Table:
    """Verdicts for all digests of a bucket, the history's and the batch's."""
    columns = {"digest": fresh.column("digest"), "keep_id": fresh.column("keep_id"), "keep_place": fresh.column("keep_place"), "group_size": fresh.column("n")}
    own = pa.table(columns | {"repeats_history": pa.array(np.zeros(fresh.num_rows, bool))})
    if not index.num_rows:
        return own
    row = index.slice(0, 1).to_pylist()[0]
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8))[: sum(row["levels"])].astype(bool)
    held = np.frombuffer(row["digests"], "<u8").reshape(-1, 4)
    sizes = np.array(row["sizes"], np.int64)
    member = np.zeros(fresh.num_rows, bool)
    if fresh.num_rows:
        words = _words(fresh.column("digest"))
        slot = slots(words, row["levels"], bits)
        member = (slot >= 0) & (held[np.maximum(slot, 0)] == words).all(axis=1)
        sizes = sizes + np.bincount(slot[member], fresh.column("n").to_numpy()[member], minlength=len(held)).astype(np.int64)
    told = pa.table({
        "digest": pa.array([row["digests"][i : i + 32] for i in range(0, len(row["digests"]), 32)], pa.binary()), "keep_id": pa.array(row["ids"], pa.int64()), "keep_place": pa.array(row["places"], pa.int64()),
        "group_size": pa.array(sizes), "repeats_history": pa.array(np.ones(len(held), bool)),
    })
    return pa.concat_tables([told, own.filter(pa.array(~member))])


def look_up(fresh: DataFrame, index: DataFrame, buckets: int) -> DataFrame:
    """Verdicts (VERDICT) for every digest of the index and of fresh (digest, keep_id, keep_place, n): a member's winner is the index's, with the batch's rows added to its group; nonmembers keep their own."""
    asked = spread(fresh.withColumn("bucket", _bucket(buckets)), "bucket", buckets)
    return asked.groupBy("bucket").cogroup(spread(index, "bucket", buckets).groupBy("bucket")).applyInArrow(lambda key, a, b: _look_up(key, a, b), VERDICT)


def dedup_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, keep_id, group_size, kept, text_sha256, repeats_history).

    The lower half of the ids is the history: its distinct digests are indexed, and the upper half
    is looked up in the index.  The halves are met by an approximate median, which changes
    nothing in the result: of equal texts the one with the smallest id stays, and an id of the
    history is below any other.  Null ids are the largest, a null text is empty.  Of rows that
    share id and text one is kept.  An empty table gives no rows.
    """
    rows = digests(docs, id_col, text_col)
    total, cut = rows.agg(F.count("*"), F.percentile_approx("doc_id", 0.5)).first()
    old = F.coalesce(F.col("doc_id") <= F.lit(cut), F.lit(False)) if cut is not None else F.lit(False)
    buckets = n_buckets(rows, total)
    index = stored(index_of(winners(rows.filter(old)), buckets))
    verdicts = stored(look_up(winners(rows.filter(~old)), index, buckets))
    dropped(index)
    out = rows.join(verdicts, "digest")
    return out.select("doc_id", "keep_id", "group_size", (F.col("place") == F.col("keep_place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "repeats_history")


#: op11_exact_dedup without its last column.
SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256 FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
