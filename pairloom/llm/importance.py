"""Target-distribution importance resampling: weights from an array of bucket gains, and an exact draw by distributed radix selection.

Each text becomes the list of its feature buckets, which is stored; corpus counts are sums over
those lists.  The gains of all buckets are one array of BUCKETS numbers, and a weight is the sum
of the gains at a document's buckets.  The k best scores are not found by a sort of all:
the composite key (score falling, id rising, place rising) is read as digits of 16 bits from the
top.  A round counts the rows that agree with the digits known so far by their next digit, which
is at most 65,536 sums, and fixes the digit in which the k-th key lies.  Only rows up to that key are
range-sorted and numbered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import dropped, stored

BUCKETS, LONGEST, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
#: Bits of a digit of the key.
DIGIT = 16
#: Polynomial of the checksum, reversed.
_CRC = 0xEDB88320


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_CRC), t >> 1)
    return t


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of data[start:end] for each pair, a byte of all spans at a time."""
    crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    order = np.argsort(starts - ends, kind="stable")  # longest first, so that the spans still open are a prefix
    at, size, own = starts[order], (ends - starts)[order], crc[order]
    live = len(at)
    for k in range(int(size[0]) if live else 0):
        live = int(np.searchsorted(-size[:live], -k, "left"))
        own[:live] = table[(own[:live] ^ data[at[:live] + k]) & np.uint32(255)] ^ (own[:live] >> np.uint32(8))
    crc[order] = own
    return crc ^ np.uint32(0xFFFFFFFF)


def bucket_lists(texts, buckets: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, how many each text has, and its number of words."""
    flat, offsets = scan.text_buffer(texts)
    table, found = _crc_table(), []
    n_words, n_features = (np.zeros(len(offsets) - 1, np.int64) for _ in range(2))
    for at, to, data, own in scan.pieces(flat, offsets):
        data = scan.FOLD[data]
        starts, ends, text = scan.word_spans(data, own, scan.ALNUM)
        counts = np.bincount(text, minlength=to - at)
        n_words[at:to] = counts
        if longest > 1:  # words of one text follow each other with one space between
            sizes = ends - starts
            place = np.concatenate([[0], np.cumsum(sizes + 1)])
            joined = np.full(place[-1], 32, np.uint8)
            joined[np.repeat(place[:-1] - starts, sizes) + _ranges(starts, sizes)] = data[_ranges(starts, sizes)]
            data, starts, ends = joined, place[:-1], place[:-1] + sizes
        keys, owner = [], []
        for n in range(1, longest + 1):
            whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.zeros(0, np.int64)
            keys.append(crc32_spans(data, starts[whole], ends[whole + n - 1], table))
            owner.append(text[whole])
        keys, owner = np.concatenate(keys), np.concatenate(owner)
        if longest > 1:
            keys = keys[np.argsort(owner, kind="stable")]
        found.append((keys % np.uint32(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32))
        n_features[at:to] = np.bincount(owner, minlength=to - at)
    return np.concatenate(found) if found else np.zeros(0, np.uint16), n_features, n_words


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    return np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(int(sizes.sum())) if len(starts) else np.zeros(0, np.int64)


def coded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """Stored rows (doc_id, n_words, n_features, codes, place): codes are the buckets of a text's features as unsigned 16- or 32-bit numbers."""

    def code(batches):
        for batch in batches:
            codes, sizes, words = bucket_lists(batch.column("text"), buckets, longest)
            ends = np.concatenate([[0], np.cumsum(sizes)]) * codes.itemsize
            # one buffer for all rows of a batch, cut by its offsets
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(codes)])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_words": pa.array(words), "n_features": pa.array(sizes), "codes": packed.cast(pa.binary())})
            scan.trim()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stored(rows.mapInArrow(code, "doc_id long, n_words long, n_features long, codes binary").withColumn("place", F.monotonically_increasing_id()))


def _codes(column, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes of a batch and where each row's begin."""
    array = column.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    kind = np.dtype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].view(kind) if data is not None and len(array) else np.zeros(0, kind)
    return flat, (offsets - offsets[0]) // kind.itemsize


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all rows of coded(): one array, of a task's own counts before the shuffle."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(_codes(batch.column("codes"), buckets)[0], minlength=buckets)
        full = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(full, pa.int32()), "n": pa.array(total[full])})

    found = rows.select("codes").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + buckets)) / ((s + 1) / (S + buckets)))) of each bucket."""
    s, t, n = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, place, weight) of coded() rows."""
    buckets = len(gain)

    def weigh(batches):
        for batch in batches:
            codes, begins = _codes(batch.column("codes"), buckets)
            sums = np.concatenate([[0], np.cumsum(gain[codes])])
            yield pa.RecordBatch.from_pydict({**{c: batch.column(c) for c in ("doc_id", "n_words", "n_features", "place")}, "weight": pa.array(sums[begins[1:]] - sums[begins[:-1]])})

    return rows.select("doc_id", "n_words", "n_features", "codes", "place").mapInArrow(weigh, "doc_id long, n_words long, n_features long, place long, weight long")


def noise(seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of a digest of seed and id; a null id counts as an empty one."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _digits() -> list[tuple[Column, int]]:
    """The composite key as (column, shift) from its top digit; each column rises as unsigned number with the order of the draw."""
    low = F.lit(-(1 << 63))
    score, doc, place = F.bitwise_not(F.col("score")).bitwiseXOR(low), F.coalesce("doc_id", F.lit((1 << 63) - 1)).bitwiseXOR(low), F.col("place").bitwiseXOR(low)
    null = F.col("doc_id").isNull().cast("long")
    return [(c, s) for c, tops in ((score, range(48, -1, -DIGIT)), (doc, range(48, -1, -DIGIT)), (null, [0]), (place, range(48, -1, -DIGIT))) for s in tops]


def kth_key(rows: DataFrame, k: int) -> tuple | None:
    """(score, doc_id, place) of the k-th of rows (score, doc_id, place) by falling score, rising id (null last) and place; None if there are fewer.

    A round reads the rows that share the digits found so far and sums them up by their next
    digit, so what comes to the driver is at most 2^DIGIT counts.  When all rows of a digit are wanted, or one is
    left, the last of them is the key.
    """
    left, first = rows, True
    for column, shift in _digits():
        digit = F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << DIGIT) - 1))
        counts = sorted((r[0], r[1]) for r in left.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect())
        if first and sum(n for _, n in counts) < k:
            return None
        first = False
        for value, n in counts:
            if n >= k:
                break
            k -= n
        left = left.filter(digit == value)
        if n == k:
            break
    # all that is left belongs to the draw: the last by the same order
    last = F.max(F.struct((-F.col("score")).alias("down"), F.col("doc_id").isNull().alias("last"), "doc_id", "place", "score")).alias("w")
    w = left.agg(last).first().w
    return w.score, w.doc_id, w.place


def _up_to(key: tuple) -> Column:
    """Whether a row is drawn: its key is not after the k-th."""
    score, doc, place = (F.lit(x).cast("long") for x in key)
    id_less = F.when(doc.isNull(), F.col("doc_id").isNotNull()).otherwise(F.coalesce(F.col("doc_id") < doc, F.lit(False)))
    same = F.col("doc_id").eqNullSafe(doc) & (F.col("place") <= place)
    return (F.col("score") > score) | ((F.col("score") == score) & (id_less | same))


def ranked(drawn: DataFrame) -> DataFrame:
    """drawn with rank 1, 2, 3... by falling score, id and place: ranges sorted on their own, shifted by the counts of those before."""
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("place"))
    # written before it is counted, as two plans of one ranging need not agree on the bounds
    placed = stored(drawn.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    at = placed.withColumn("_range", F.shiftright("_at", 33))
    before = at.groupBy("_range").count().withColumn("_before", F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # a row for each range, so its size is bounded by the number of partitions
    out = at.join(F.broadcast(before.select("_range", "_before")), "_range")
    return out.withColumn("rank", (F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before") + 1).cast("long")).drop("_at", "_range", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED, buckets: int = BUCKETS, longest: int = LONGEST, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """One row for each row of docs: (doc_id, n_features, weight, score, rank); rank is null for what is not drawn.

    Of the documents with at least least_words words the floor(percent / 100) with the highest scores are drawn,
    equal scores by the smaller id.  A null or empty text has no features and weight 0; a null id
    comes last among equal scores and has the noise of an empty id.  Rows that share an id are separate
    documents with the same noise.  An empty target has T = 0; an empty docs gives no rows.
    """
    rows, wanted = coded(docs, id_col, text_col, buckets, longest), coded(target.select(F.lit(0).alias("doc_id"), F.col(target_col).alias("text")), "doc_id", "text", buckets, longest)
    gain = gains(bucket_counts(rows, buckets), bucket_counts(wanted, buckets))
    scored = stored(weighed(rows, gain).withColumn("score", F.col("weight") + noise(seed)))
    dropped(rows, wanted)
    able = scored.filter(F.col("n_words") >= least_words)
    k = able.count() * percent // 100
    key = kth_key(able.select("score", "doc_id", "place"), k) if k > 0 else None
    columns = ("doc_id", "n_features", "weight", "score")
    if key is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen = (F.col("n_words") >= least_words) & _up_to(key)
    rest = scored.filter(~chosen).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(scored.filter(chosen)).select(*columns, "rank").union(rest)


#: For the defaults above.
SQL = r"""
WITH RECURSIVE crc(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(0, 256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8
), steps AS (SELECT list(c ORDER BY i) AS step FROM crc WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(@LOWER@, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(@LOWER@, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
one AS (SELECT DISTINCT unnest(w) AS x FROM (SELECT w FROM d UNION ALL SELECT w FROM b)),
code AS (
  SELECT x, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, strlen(x)), lambda k: ('0x' || substr(hex(encode(x)), 2 * k + 1, 2))::BIGINT)), lambda c, y: xor(c >> 8, step[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS bucket FROM one CROSS JOIN steps
), dw AS (SELECT doc_id, bucket, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x FROM d) JOIN code USING (x) GROUP BY doc_id, bucket),
s AS (SELECT bucket, sum(n) AS n FROM dw GROUP BY bucket), t AS (SELECT bucket, count(*) AS n FROM (SELECT unnest(w) AS x FROM b) JOIN code USING (x) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT sum(n) FROM s) + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)
), weight AS (SELECT doc_id, sum(n * g)::BIGINT AS weight FROM dw JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN weight USING (doc_id)
), placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank FROM scored LEFT JOIN placed USING (doc_id)
""".replace("@LOWER@", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
