"""Suffix-array dedup: removes every byte of a string of LENGTH bytes that also starts in a document with a smaller id.

Sorting all suffixes would move LENGTH times the text.  Equal strings of LENGTH bytes have
equal minimizers (the SEED-byte piece with the smallest hash, leftmost of equals) at the
same place, so the suffixes that begin at minimizers are enough: what lies before is at most
REACH = LENGTH - SEED bytes.  The block exchange first tells which minimizers occur in two documents
at all; a chance agreement of hashes there only lets one more suffix in.

A suffix's key is its first LENGTH bytes and then the REACH bytes before it, from right to left.
Keys are sorted by multikey quicksort; a string that starts d bytes before two minimizers is the same
if their suffixes share LENGTH - d bytes (a run of neighbours in the order) and d bytes on the
left (a run in the order of the left sides).  This is done in each block of documents first, where
whatever a smaller document of the block has is settled and equal keys become one, so that
a group of copies sends one suffix a block.  What remains is range-partitioned by whole keys at
sampled splitters, so that a frequent beginning is cut by what follows and by what lies before.

A run may therefore cross a bucket's boundary.  Its suffixes share their beginning with the
splitter there, so a bucket knows them, and their strings are compared across all
boundaries: grouped by the string itself, the smallest document of all buckets decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import answers, exchange, ids_of, in_blocks, n_blocks, RANGE_BYTES, settled, sized_join, spread, stored, text_bytes

#: Bytes of minimizers.
SEED = 16
#: Bytes of text in a block, and behind a bucket; fewest buckets.
BLOCK, BUCKET, BUCKETS = 6 << 20, 4 << 20, 48
#: Sampled documents for splitters (at least, for each bucket, at most), and suffixes of each.
SAMPLE_DOCS, SAMPLE_EACH = (2000, 4, 50_000), 8
#: Odd multipliers of a piece's two words.
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _ordered(table: pa.Table) -> pa.Table:
    """Rows in an order that depends on their ids and texts alone."""
    return table.select(["doc_id", "text"]).sort_by([("doc_id", "ascending"), ("text", "ascending")])


def _minimizers(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each minimizer of a string of length bytes: hash, text, place, and how far before it the nearest and the farthest such string starts."""
    if len(data) < length:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    words, count = scan.eights(data), len(data) - SEED + 1
    # which piece is smallest only has to follow from its bytes: the upper bits of two products
    low = words[:count] * _FIRST
    low ^= words[8 : 8 + count] * _SECOND
    low &= np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(count, dtype=np.uint64)
    width, span = 1, length - SEED + 1
    while width * 2 <= span:
        low, width = np.minimum(low[:-width], low[width:]), width * 2
    if rest := span - width:
        low = np.minimum(low[:-rest], low[rest:])
    inside = np.ones(len(low) + 2, bool)  # whether a string starts here, with an edge on both sides
    inside[[0, -1]] = False
    for end in offsets[1:].tolist():
        inside[max(1, end - length + 2) : end + 1] = False
    new = np.ones(len(low) + 1, bool)
    new[1:-1] = low[1:] != low[:-1]
    first = np.flatnonzero(inside[1:-1] & (new[:-1] | ~inside[:-2]))
    last = np.flatnonzero(inside[1:-1] & (new[1:] | ~inside[2:]))
    place = (low[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(offsets, first, "right") - 1
    return scan.mix(scan.mix(words[place]) + words[place + 8]), text, place, place - last, place - first


def _all_minimizers(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """_minimizers() of a whole block; texts and places count from the block's beginning."""
    parts = []
    for at, _, data, own in scan.pieces(flat, offsets, 1 << 18):
        seed, text, place, low, high = _minimizers(data, own, length)
        parts.append((seed, (text + at).astype(np.int32), place + offsets[at], low.astype(np.uint8), high.astype(np.uint8)))
    kinds = (np.uint64, np.int32, np.int64, np.uint8, np.uint8)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else tuple(np.zeros(0, k) for k in kinds)


def _seeds(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The block's distinct minimizer hashes and in how many documents each is."""
    flat, offsets = scan.text_buffer(table.column("text"))
    seed, text, *_ = _all_minimizers(flat, offsets, length)
    _, doc = np.unique(ids_of(table), return_inverse=True)
    return scan.counted(scan.distinct_by_text(seed, doc[text])[0])


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Order of rows of words by multikey quicksort: a segment is split by its word at one depth into less, equal and greater than a median of three; the equal part goes on with the next word.

    All open segments are split in the same pass; there are some log n + depth passes.  The
    first one splits by the leading two bytes at once.
    """
    n, depth = words.shape
    flat, small = np.ascontiguousarray(words).ravel(), np.int32 if words.size < 1 << 31 else np.int64
    lead = (words[:, 0] >> np.uint64(48)).astype(np.uint16)
    order = np.argsort(lead, kind="stable").astype(small)
    size = np.bincount(lead, minlength=1).astype(small)
    start, level = np.cumsum(size, dtype=small) - size, np.zeros(len(size), small)
    while True:
        open_ = (size > 1) & (level < depth)
        start, size, level = start[open_], size[open_], level[open_]
        if not len(start):
            return order
        ends = np.cumsum(size, dtype=small)
        base = ends - size
        seg = np.repeat(np.arange(len(size), dtype=small), size)
        place = np.arange(len(seg), dtype=small)
        rows = order[place + (start - base)[seg]]
        word = flat[rows * small(depth) + level[seg]]
        a, b, c = word[base], word[base + size // 2], word[ends - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[seg]
        less, equal = word < pivot, word == pivot
        n_less, n_equal = np.zeros(len(seg) + 1, small), np.zeros(len(seg) + 1, small)
        np.cumsum(less, out=n_less[1:])
        np.cumsum(equal, out=n_equal[1:])
        l0, e0 = n_less[base], n_equal[base]
        lesses, equals = n_less[ends] - l0, n_equal[ends] - e0
        # where the three parts go: those before in the same part, after the parts before
        to = np.where(less, n_less[:-1] + (start - l0)[seg], np.where(equal, n_equal[:-1] + (start + lesses - e0)[seg], place - n_less[:-1] - n_equal[:-1] + (start + lesses + equals + l0 + e0 - base)[seg]))
        order[to] = rows
        start = np.concatenate([start, start + lesses, start + lesses + equals])
        size = np.concatenate([lesses, equals, size - lesses - equals])
        level = np.concatenate([level, level + 1, level])


def _shared(words: np.ndarray) -> np.ndarray:
    """Bytes that each row of big-endian words, but the first, shares with the one before."""
    apart = words[1:] ^ words[:-1]
    word = (apart != 0).argmax(axis=1)
    value = apart[np.arange(len(apart)), word]
    # the leading zero bytes of the first word that differs
    lead = sum(((value >> np.uint64(8 * k)) == 0).astype(np.int64) for k in range(8))
    return np.where(value == 0, 8 * words.shape[1], 8 * word + lead)


def _words(key: np.ndarray) -> np.ndarray:
    """Rows of bytes as big-endian words; zeros fill the last."""
    wide = np.zeros((len(key), -(-key.shape[1] // 8) * 8), np.uint8)
    wide[:, : key.shape[1]] = key
    return wide.view(">u8").astype(np.uint64)


def _smallest(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that each row's key has."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)
    out = np.empty_like(ids)
    out[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(key))))
    return out


def _later(key: np.ndarray, docs: np.ndarray, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which strings at these suffixes a smaller document has too.

    key: rows of length + REACH bytes.  Gives each row's group (rows of equal key, low and
    high), the first row of the smallest document of each group, and, for that row, a column
    for each start d: whether a smaller document has the string.
    """
    reach = length - SEED
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, reach + 1), bool)
    words = _words(key)
    order = multikey_sort(words)
    common = np.concatenate([[0], _shared(words[order])])
    alike = np.empty(len(key), np.int64)
    alike[order] = np.cumsum(common < length + reach) - 1
    heads = order[common < length + reach]
    run, run_lcp = np.arange(len(heads)), np.minimum(common[common < length + reach], length)
    near = np.maximum(run_lcp, np.append(run_lcp[1:], 0))
    ranked = np.lexsort((docs, high, low, alike))
    new = np.ones(len(key), bool)
    new[1:] = (alike[ranked][1:] != alike[ranked][:-1]) | (low[ranked][1:] != low[ranked][:-1]) | (high[ranked][1:] != high[ranked][:-1])
    group = np.empty(len(key), np.int64)
    group[ranked] = np.cumsum(new) - 1
    least = ranked[new]
    doc, kind, lo, hi = docs[least], alike[least], low[least], high[least]
    # a suffix that shares less than that with its neighbours in the order shares it with none
    near[np.bincount(kind, minlength=len(heads)) > 1] = length
    kept = np.flatnonzero(near >= SEED)
    left = _words(key[heads[kept]][:, length:])
    left_order = multikey_sort(left)
    left_lcp, left_order = np.concatenate([[0], _shared(left[left_order])]), kept[left_order]
    near = near[kind]
    later, side = np.zeros((len(least), reach + 1), bool), np.zeros(len(heads), np.int64)
    for d in range(reach + 1):
        at = np.flatnonzero((lo <= d) & (d <= hi) & (near >= length - d))
        if len(at):
            side[left_order] = np.cumsum(left_lcp[: len(kept)] < d) if d else 0
            run = np.cumsum(run_lcp < length - d)
            later[at, d] = doc[at] > _smallest(run[kind[at]] * (len(heads) + 1) + side[kind[at]], doc[at])
    return group, least, later


def _spans(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first start, last start) with neighbours joined; no two overlap."""
    order = np.lexsort((first, rows))
    rows, first, last = rows[order], first[order], last[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (first[1:] > last[:-1] + 1)
    at = np.flatnonzero(new)
    return rows[at], first[at], last[np.append(at[1:], len(rows)) - 1] if len(at) else last


def _starts(rows: np.ndarray, places: np.ndarray, low: np.ndarray, high: np.ndarray, whole: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of the starts to remove: all from low to high before a place where whole holds, else those that some (a column for each start) names."""
    i, d = np.nonzero(some & ~whole[:, None])
    return _spans(np.concatenate([rows[whole], rows[i]]), np.concatenate([(places - high)[whole], places[i] - d]), np.concatenate([(places - low)[whole], places[i] - d]))


_RECORD = "bucket int, block int, rows binary, first binary, last binary, docs binary, low binary, high binary, keys binary, owner binary, text binary, place binary"
_TOLD = "block int, rows binary, first binary, last binary, string binary, doc long"


def _keys(flat: np.ndarray, place: np.ndarray, begin: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """A suffix's length bytes, then those before it, from right to left; zeros where its text has ended or not begun."""
    reach = length - SEED
    padded = np.concatenate([np.zeros(reach, np.uint8), flat, np.zeros(length, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, reach + length)[place]
    near = np.flatnonzero((place - begin < reach) | (end - place < length))
    at = place[near, None] + np.arange(-reach, length)[None, :]
    around[near] = np.where((at >= begin[near, None]) & (at < end[near, None]), around[near], 0)
    return np.concatenate([around[:, reach:], around[:, :reach][:, ::-1]], axis=1)


def _suffixes(block: int, table: pa.Table, found: pa.Table, length: int, splitters: np.ndarray) -> pa.Table:
    """One row without suffixes, with what the block has settled itself, and one for each bucket that the others go to."""
    scan.trim()
    table = _ordered(table)
    flat, offsets = scan.text_buffer(table.column("text"))
    ids = ids_of(table)
    seed, text, place, low, high = _all_minimizers(flat, offsets, length)
    again = answers(found)[scan.classes(seed)[2]] > 1
    text, place, low, high = text[again], place[again], low[again], high[again]
    doc, key = ids[text], _keys(flat, place, offsets[text], offsets[text + 1], length)
    group, least, later = _later(key, doc, low, high, length)
    whole = doc > doc[least][group]
    local = place - offsets[text]
    done = _starts(text, local, low.astype(np.int64), high.astype(np.int64), whole, later[group])
    out = {k: [] for k in (x.split(" ")[0] for x in _RECORD.split(", "))}

    def put(*values):
        for k, v in zip(out, values, strict=True):
            out[k].append(v)

    put(block % (len(splitters) + 1), block, *(x.tobytes() for x in (done[0].astype(np.int32), done[1].astype(np.int64), done[2].astype(np.int64))), *[b""] * 7)
    # a group's other strings go to its bucket, with all its places in the smallest document
    d = np.arange(later.shape[1])
    sent = np.flatnonzero((~later & (low[least][:, None] <= d) & (d <= high[least][:, None])).any(axis=1))
    number = np.full(len(least), -1)
    number[sent] = np.arange(len(sent))
    own = np.flatnonzero(~whole & (number[group] >= 0))
    own = own[np.argsort(number[group[own]], kind="stable")]
    owner = number[group[own]]
    key, least = np.ascontiguousarray(key[least[sent]]), least[sent]
    bucket = np.searchsorted(splitters, key.view(f"S{key.shape[1]}").ravel(), "right") if len(key) else np.zeros(0, np.int64)
    order = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[order], np.arange(len(splitters) + 2))
    squeeze = pa.Codec("zstd", compression_level=1)
    first = np.searchsorted(owner, np.arange(len(sent) + 1))
    for b in np.flatnonzero(edges[1:] > edges[:-1]):
        i = order[edges[b] : edges[b + 1]]
        many = first[i + 1] - first[i]
        at = own[np.repeat(first[i] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))]
        put(int(b), block, b"", b"", b"", *(x.tobytes() for x in (doc[least[i]], low[least[i]], high[least[i]])), squeeze.compress(key[i].tobytes(), asbytes=True), *(x.tobytes() for x in (many.astype(np.int32), text[at], local[at])))
    return pa.table({k: pa.array(v, pa.int32() if k in ("bucket", "block") else pa.binary()) for k, v in out.items()})


def _bucket(table: pa.Table, length: int, splitters: np.ndarray) -> pa.Table:
    """Of _TOLD: spans of strings that a smaller document has too, and, without a verdict, the strings whose run may cross the bucket's boundaries, with the smallest document here."""
    scan.trim()
    reach, unpack = length - SEED, pa.Codec("zstd")
    full = [i for i, x in enumerate(table.column("docs")) if len(x.as_buffer())]
    get = lambda name, kind: [np.frombuffer(table.column(name)[i].as_buffer(), kind) for i in full]
    out = {k: [] for k in (x.split(" ")[0] for x in _TOLD.split(", "))}

    def put(*values):
        for k, v in zip(out, values, strict=True):
            out[k].append(v)

    for i in sorted(set(range(table.num_rows)) - set(full)):
        put(*(table.column(k)[i].as_py() for k in ("block", "rows", "first", "last")), None, None)
    if full:
        wide, number = reach + length, table.column("bucket")[0].as_py()
        each = [len(x) for x in get("low", np.uint8)]
        docs, low, high, many, texts, places = (np.concatenate(get(n, t)) for n, t in (("docs", np.int64), ("low", np.uint8), ("high", np.uint8), ("owner", np.int32), ("text", np.int32), ("place", np.int64)))
        blocks = np.repeat([table.column("block")[i].as_py() for i in full], each)
        key = np.concatenate([np.frombuffer(unpack.decompress(table.column("keys")[i].as_buffer(), n * wide), np.uint8).reshape(n, wide) for i, n in zip(full, each, strict=True)])
        group, least, later = _later(key, docs, low, high, length)
        whole, later = docs > docs[least][group], later[group]
        owner = np.repeat(np.arange(len(docs)), many)
        for part in np.split(np.arange(len(owner)), np.flatnonzero(np.diff(blocks[owner])) + 1):
            o = owner[part]
            r, first, last = _starts(texts[part], places[part], low[o].astype(np.int64), high[o].astype(np.int64), whole[o], later[o])
            if len(r):
                put(int(blocks[o[0]]), r.astype(np.int32).tobytes(), first.astype(np.int64).tobytes(), last.astype(np.int64).tobytes(), None, None)
        # bytes shared with the splitters at both ends: runs that may go on beyond them
        ends = splitters[max(0, number - 1) : number + 1]
        ends = np.frombuffer(b"".join(bytes(x).ljust(wide, b"\0") for x in ends), np.uint8).reshape(-1, wide)
        beyond = np.zeros(len(key), np.int64)
        for e in ends:
            differ = key[:, :length] != e[:length]
            beyond = np.maximum(beyond, np.where(differ.any(axis=1), differ.argmax(axis=1), length))
        d = np.arange(reach + 1)
        i, d = np.nonzero(~whole[:, None] & ~later & (low[:, None] <= d) & (d <= high[:, None]) & (length - d <= beyond[:, None]))
        first = np.cumsum(many) - many
        for k, back in zip(i.tolist(), d.tolist(), strict=True):
            own = slice(first[k], first[k] + many[k])
            string = key[k, length : length + back][::-1].tobytes() + key[k, : length - back].tobytes()
            at = (places[own] - back).astype(np.int64).tobytes()
            put(int(blocks[k]), texts[own].tobytes(), at, at, string, int(docs[k]))
    return pa.table({k: pa.array(v, {"block": pa.int32(), "doc": pa.int64()}.get(k, pa.binary())) for k, v in out.items()})


def _cut(table: pa.Table, found: pa.Table, length: int) -> pa.Table:
    scan.trim()
    table = _ordered(table)
    flat, offsets = scan.text_buffer(table.column("text"))
    get = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in found.column(name))])
    row, first, last = get("rows", np.int32), get("first", np.int64), get("last", np.int64)
    start, end = offsets[row] + first, offsets[row] + last + length
    order = np.argsort(start, kind="stable")
    row, start, end = row[order], start[order], np.maximum.accumulate(end[order]) if len(order) else end
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])  # no string leaves its document
    at = np.flatnonzero(new)
    row, start, end = row[at], start[at], end[np.append(at[1:], len(end)) - 1] if len(at) else end
    gone = np.zeros(len(flat) + 1, np.int8)
    gone[start] += 1
    gone[end] -= 1
    kept = flat[np.cumsum(gone[:-1], dtype=np.int8) == 0]
    n = len(offsets) - 1
    removed = np.bincount(row, end - start, minlength=n).astype(np.int64)
    kept_at = (offsets - np.concatenate([[0], np.cumsum(removed)])).tolist()
    data = kept.tobytes()
    return pa.table({
        "doc_id": table.column("doc_id"), "n_bytes": pa.array(np.diff(offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
        "n_spans": pa.array(np.bincount(row, minlength=n), pa.int64()), "kept": pa.array([data[a:b] for a, b in zip(kept_at[:-1], kept_at[1:], strict=True)], pa.binary()),
    })


def sample_splitters(docs: DataFrame, buckets: int, length: int) -> np.ndarray:
    """Keys at which suffixes are dealt, from a bounded sample of documents; only the balance depends on them."""
    least, each, most = SAMPLE_DOCS
    wanted = min(most, max(least, each * buckets))

    def some(tables):
        for batch in tables:
            flat, offsets = scan.text_buffer(batch.column("text"))
            seed, text, place, *_ = _all_minimizers(flat, offsets, length)
            order = np.lexsort((seed, text))
            rank = np.arange(len(order)) - np.searchsorted(text[order], text[order])
            at = np.sort(order[rank < SAMPLE_EACH])
            keys = _keys(flat, place[at], offsets[text[at]], offsets[text[at] + 1], length)
            yield pa.RecordBatch.from_pydict({"h": batch.column("h").take(pa.array(text[at])), "key": pa.array([k.tobytes() for k in keys], pa.binary())})

    # by the hash of the text, so that a group of copies is one draw
    share = min(1_000_000, 2 * 1_000_000 * wanted // max(1, docs.count()))
    drawn = docs.filter(F.octet_length("text") >= length).select("text", F.xxhash64("text", F.lit("splitters")).alias("h"))
    few = drawn.filter(F.pmod("h", F.lit(1_000_000)) < F.lit(max(1, share))).mapInArrow(some, "h long, key binary").distinct()
    keys = np.sort(np.array([r.key for r in few.orderBy("h", "key").limit(wanted * SAMPLE_EACH).collect()], dtype=f"S{2 * length - SEED}"))
    return np.unique(keys[(np.arange(1, buckets) * len(keys)) // buckets]) if len(keys) else keys


def remove_repeats(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept (remaining bytes).

    Every byte of a string of length bytes (over SEED, at most 271) that also starts in a
    document with a smaller id goes; strings are judged on the input and never cross
    documents.  Null texts count as empty.  Rows of one id are not smaller than each other;
    a null id counts as the largest.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    settled(spark)
    total = text_bytes(docs, text_col)
    blocks, ranges, buckets = n_blocks(spark, total, BLOCK), max(16, -(-total // RANGE_BYTES)), max(BUCKETS, -(-total // BUCKET))
    dealt = in_blocks(docs, blocks, id_col, text_col)
    splitters = sample_splitters(dealt, buckets, length)
    found = exchange(dealt, blocks, ranges, lambda table: _seeds(table, length))
    dealt = spread(dealt, "block", blocks)
    asked = dealt.groupBy("block").cogroup(spread(found, "block", blocks).groupBy("block")).applyInArrow(lambda key, left, right: _suffixes(key[0].as_py(), left, right, length, splitters), _RECORD)
    told = stored(spread(asked, "bucket", buckets).groupBy("bucket").applyInArrow(lambda table: _bucket(table, length, splitters), _TOLD))
    across = told.filter("string is not null")
    least = stored(across.groupBy("string").agg(F.min("doc").alias("least"), F.count("*").alias("n")).filter("n > 1").select("string", "least"))
    late = sized_join(across, least, "string", "inner", 128).filter("doc > least")
    told = told.filter("string is null").unionByName(late, allowMissingColumns=True).select("block", "rows", "first", "last")
    return dealt.groupBy("block").cogroup(spread(told, "block", blocks).groupBy("block")).applyInArrow(lambda left, right: _cut(left, right, length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


#: The contract's rows in DuckDB SQL, over documents; bytes are pairs of hexadecimal digits.
SQL = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), pieces AS (
  SELECT doc_id, c, len(x) // 2 AS n, substring(x, 512 * c + 1, 612) AS y FROM (SELECT doc_id, x, unnest(range(0, (len(x) // 2 + 206) // 256)) AS c FROM d)
), strings AS (
  SELECT doc_id, k, substring(y, 2 * (k % 256) + 1, 100) AS s FROM (SELECT doc_id, y, unnest(range(256 * c, least(256 * c + 256, n - 49))) AS k FROM pieces)
), late AS (
  SELECT doc_id, k FROM strings JOIN (SELECT s, min(doc_id) AS first FROM strings GROUP BY s HAVING min(doc_id) < max(doc_id)) USING (s) WHERE doc_id > first
), marked AS (
  SELECT doc_id, k, CASE WHEN k <= lag(k) OVER (PARTITION BY doc_id ORDER BY k) + 50 THEN 0 ELSE 1 END AS new FROM late
), spans AS (
  SELECT doc_id, g, min(k) AS a, max(k) + 50 AS b FROM (SELECT doc_id, k, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS g FROM marked) GROUP BY doc_id, g
), gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, a AS b FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT doc_id, max(b), NULL FROM spans GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(CASE WHEN g.b IS NULL THEN substring(x, 2 * g.a + 1) ELSE substring(x, 2 * g.a + 1, 2 * (g.b - g.a)) END, '' ORDER BY g.a) AS y FROM gaps g JOIN d USING (doc_id) GROUP BY doc_id
), sums AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
