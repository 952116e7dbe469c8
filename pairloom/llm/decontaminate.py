"""Benchmark decontamination by a distributed positional inverted index.

build_index() stores the postings of all training tokens, a row for each block of documents: the
sorted term hashes, where each one's postings begin, and the token positions (documents of a
block one after the other).  A query is a portion of distinct benchmark windows of bounded
size, made by the executors.  For each window a block takes the postings of its rarest term
and keeps those whose offset-adjusted places the other lists hold too, the rarer first
(exact phrases), or near which all other terms stand (proximity).  Candidates are worked
off in portions of bounded size, so that a window of frequent words takes time, not memory.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import ids_of, in_blocks, n_blocks, pack_rising, settled, spread, stored, text_bytes, unpack_rising

#: Words of a benchmark window, and by how many more words its terms may be spread to count as near.
WINDOW, SLOP = 10, 5
#: Bytes of text in a block, pairs of window and item in a query, and candidates matched at once.
BLOCK, QUERY_PAIRS, CANDIDATES = 8 << 20, 200_000, 1 << 19

_INDEX = "block int, n_terms int, n_words int, terms binary, begins binary, positions binary, docs binary, unnamed binary, doc_begins binary"
_SQUEEZE = pa.Codec("zstd", compression_level=1)
_LAST = np.iinfo(np.int64).max
#: Farther than any word of a block.
FAR = 1 << 40


def _post(key, table: pa.Table) -> pa.Table:
    """One block's postings."""
    scan.trim()
    flat, offsets = scan.text_buffer(table.column("text"))
    words, doc_begins = scan.word_hashes(flat, offsets, scan.ALNUM)
    order = scan.order_of(words)
    words = words[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])[: len(words)])
    # positions rise within a list, so most steps are small
    steps = np.diff(order.astype(np.uint32), prepend=np.uint32(0)).astype(np.uint32)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)
    return pa.table({
        "block": pa.array([key[0].as_py()], pa.int32()), "n_terms": pa.array([len(first)], pa.int32()), "n_words": pa.array([len(words)], pa.int32()),
        "terms": pa.array([pack_rising(words[first])], pa.binary()), "begins": pa.array([pack_rising(np.append(first, len(words)).astype(np.uint64))], pa.binary()),
        "positions": pa.array([_SQUEEZE.compress(planes.tobytes(), asbytes=True)], pa.binary()),
        # null ids and the largest one have the same number, so the bits tell which are null
        "docs": pa.array([ids_of(table).tobytes()], pa.binary()), "unnamed": pa.array([np.packbits(table.column("doc_id").is_null().to_numpy()).tobytes()], pa.binary()), "doc_begins": pa.array([doc_begins.astype(np.int64).tobytes()], pa.binary()),
    })


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored positional index of docs; words are [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z.  Null texts have no words."""
    settled(docs.sparkSession)
    blocks = n_blocks(docs.sparkSession, text_bytes(docs, text_col), BLOCK)
    dealt = spread(in_blocks(docs, blocks, id_col, text_col), "block", blocks)
    return stored(dealt.groupBy("block").applyInArrow(lambda key, table: _post(key, table), _INDEX))


class Postings:
    """One block's index in memory, from row k of a batch or table of the index."""

    def __init__(self, rows: pa.RecordBatch | pa.Table, k: int):
        cells = {c: rows.column(c)[k] for c in rows.schema.names}
        row = {c: v.as_buffer() if pa.types.is_binary(v.type) else v.as_py() for c, v in cells.items()}
        n, m = row["n_terms"], row["n_words"]
        self.docs, self.doc_begins = np.frombuffer(row["docs"], np.int64), np.frombuffer(row["doc_begins"], np.int64)
        self.unnamed = np.unpackbits(np.frombuffer(row["unnamed"], np.uint8), count=len(self.docs)).astype(bool)
        self.terms, self.begins = unpack_rising(row["terms"], n), unpack_rising(row["begins"], n + 1).astype(np.int64)
        planes = np.frombuffer(_SQUEEZE.decompress(row["positions"], 4 * m), np.uint8).reshape(4, m)
        self.positions = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32).astype(np.int32)

    def lookup(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 if the block has none."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def at_least(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Index of the first posting of each term at or after the position, by bisection of its list; the list's end if there is none."""
        low, high = self.begins[term], self.begins[term + 1]
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (low + high) >> 1
            less = (low < high) & (self.positions[np.minimum(middle, len(self.positions) - 1)] < position)
            low, high = np.where(less, middle + 1, low), np.where(less, high, np.maximum(low, middle))
        return low

    def has(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        at = self.at_least(term, position)
        return (at < self.begins[term + 1]) & (self.positions[np.minimum(at, len(self.positions) - 1)] == position)

    def beside(self, term: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far the nearest posting of each term is to the left and to the right (0: at the position); FAR if there is none."""
        at = self.at_least(term, position)
        right = np.where(at < self.begins[term + 1], self.positions[np.minimum(at, len(self.positions) - 1)] - position, FAR)
        left = np.where(at > self.begins[term], position - self.positions[np.maximum(at - 1, 0)], FAR)
        return np.where(right == 0, 0, left), right

    def documents(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.doc_begins, positions, "right") - 1


class Query:
    """Distinct windows with the items that have them: terms as places in a sorted vocabulary."""

    def __init__(self, windows: list[bytes], items: list[int], window: int):
        names = {w: k for k, w in enumerate(dict.fromkeys(windows))}
        self.sizes = np.array([len(w) // 8 for w in names], np.int64)
        padded = np.frombuffer(b"".join(w.ljust(8 * window, b"\0") for w in names), np.uint64).reshape(-1, window)
        self.slots = np.arange(window)[None, :] < self.sizes[:, None]
        self.vocabulary, places = np.unique(padded[self.slots], return_inverse=True)
        self.phrases = np.zeros(padded.shape, np.int32)
        self.phrases[self.slots] = places
        of = np.array([names[w] for w in windows], np.int64)
        order = np.argsort(of, kind="stable")
        self.items = np.array(items, np.int64)[order]
        self.begins = np.searchsorted(of[order], np.arange(len(names) + 1))

    def pairs(self, doc: np.ndarray, window: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, item) of each document and each item of a window that it has, once and sorted."""
        count = self.begins[window + 1] - self.begins[window]
        at = np.repeat(self.begins[window] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        found = np.unique(np.stack([np.repeat(doc, count), self.items[at]], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
        return found[:, 0], found[:, 1]


def search(index: Postings, query: Query, slop: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(window, place) in portions: the first position of every exact occurrence within one document, or, with slop, each position of the rarest term around which all terms stand, in any order, within size + slop consecutive words of its document."""
    terms = np.where(query.slots, index.lookup(query.vocabulary)[query.phrases] if len(query.vocabulary) else -1, -1)
    live = np.flatnonzero(((terms >= 0) | ~query.slots).all(axis=1) & (query.sizes > 0))
    terms, slots, sizes = terms[live], query.slots[live], query.sizes[live]
    lengths = np.where(slots, index.begins[terms + 1] - index.begins[terms], _LAST)
    order = np.argsort(lengths, axis=1, kind="stable")
    rare = terms[np.arange(len(live)), order[:, 0]] if len(live) else np.zeros(0, np.int64)
    ends = np.cumsum(index.begins[rare + 1] - index.begins[rare])
    step = CANDIDATES if slop is None else max(1, CANDIDATES // terms.shape[1])
    for at in range(0, int(ends[-1]) if len(ends) else 0, step):
        which = np.arange(at, min(at + step, int(ends[-1])))
        window = np.searchsorted(ends, which, "right")
        place = index.positions[which - ends[window] + index.begins[rare[window] + 1]].astype(np.int64)
        found = (_exact if slop is None else _near)(index, terms, slots, sizes, order, window, place, slop)
        yield live[found[0]], found[1]


def _exact(index, terms, slots, sizes, order, window, place, _):
    """Of candidates (window, place of its rarest term) those whose other terms stand where the window has them, as first positions."""
    start = place - order[window, 0]
    window, start = window[start >= 0], start[start >= 0]
    keep = start + sizes[window] <= index.doc_begins[index.documents(start) + 1]
    window, start = window[keep], start[keep]
    for k in range(1, terms.shape[1]):
        slot = order[window, k]
        more = np.flatnonzero(slots[window, slot])
        keep = np.ones(len(window), bool)
        keep[more] = index.has(terms[window[more], slot[more]], start[more] + slot[more])
        window, start = window[keep], start[keep]
    return window, start


def _near(index, terms, slots, sizes, order, window, place, slop):
    """Of candidates those with an interval of size + slop words of the document that holds the place and all terms."""
    left, right = np.zeros((len(window), 1), np.int64), np.zeros((len(window), 1), np.int64)
    for k in range(1, terms.shape[1]):
        doc, reach = index.documents(place), sizes[window] - 1 + slop
        slot = order[window, k]
        more = np.flatnonzero(slots[window, slot])
        l, r = np.zeros(len(window), np.int64), np.zeros(len(window), np.int64)
        l[more], r[more] = index.beside(terms[window[more], slot[more]], place[more])
        l[l > np.minimum(reach, place - index.doc_begins[doc])] = FAR
        r[r > np.minimum(reach, index.doc_begins[doc + 1] - 1 - place)] = FAR
        keep = np.minimum(l, r) < FAR
        window, place = window[keep], place[keep]
        left, right = np.column_stack([left, l])[keep], np.column_stack([right, r])[keep]
    good, reach = np.zeros(len(window), bool), sizes[window] - 1 + slop
    for k in range(left.shape[1]):  # the interval begins at the left posting of one term; the terms not in it yet are reached to the right
        good |= left[:, k] + np.where(left > left[:, k : k + 1], right, 0).max(axis=1) <= reach
    return window[good], place[good]


def _windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct (terms, item_id): the hashes of each window's words.  An item of fewer words, but not none, is one window."""

    def cut(batches):
        for batch in batches:
            words, begins = scan.word_hashes(*scan.text_buffer(batch.column(1)), scan.ALNUM)
            counts, raw = np.diff(begins), words.tobytes()
            many = np.where(counts >= window, counts - window + 1, (counts > 0).astype(np.int64))
            owner = np.repeat(np.arange(len(counts)), many)
            first = begins[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            last = first + np.minimum(window, counts[owner])
            yield pa.RecordBatch.from_pydict({"terms": pa.array([raw[8 * a : 8 * b] for a, b in zip(first.tolist(), last.tolist(), strict=True)], pa.binary()), "item_id": batch.column(0).take(pa.array(owner))})

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).filter("item_id is not null and text is not null")
    return rows.mapInArrow(cut, "terms binary, item_id long").distinct()


def _queries(items: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[tuple[int, Query]]:
    """(number of portions, query): one portion after the other comes to the driver, at most some QUERY_PAIRS pairs each."""
    pairs = stored(_windows(items, window, id_col, text_col))
    portions = max(1, -(-pairs.count() // QUERY_PAIRS))
    pairs = pairs.withColumn("portion", F.pmod(F.xxhash64("terms", "item_id"), F.lit(portions)))
    for p in range(portions):
        own = pairs.filter(F.col("portion") == p).select("terms", "item_id").toArrow()
        yield portions, Query(own.column(0).to_pylist(), own.column(1).to_pylist(), window)


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, pa.int64()))


def _rows(index: Postings, block: int) -> dict:
    n = len(index.docs)
    return {
        "block": pa.array([block] * n, pa.int32()), "row": pa.array(np.arange(n), pa.int64()), "doc_id": pa.array(index.docs, pa.int64(), mask=index.unnamed),
        "n_words": pa.array(np.diff(index.doc_begins), pa.int64()),
    }


def _match(index: Postings, block: int, query: Query, slop: int | None) -> pa.RecordBatch:
    """Of matches(): a row for each document."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)), *search(index, query, slop)]
    window, place = (np.concatenate(x) for x in zip(*found, strict=True))
    doc = index.documents(place)
    order = np.lexsort((place, doc))
    window, place, doc = window[order], place[order], doc[order]
    count = query.begins[window + 1] - query.begins[window]
    each = np.repeat(np.arange(len(window)), count)
    item = query.items[np.repeat(query.begins[window] - (np.cumsum(count) - count), count) + np.arange(len(each))]
    values = [pa.array(x, pa.int64()) for x in (item, (place - index.doc_begins[doc])[each], query.sizes[window][each])]
    return pa.RecordBatch.from_pydict(_rows(index, block) | {"hits": _lists(pa.StructArray.from_arrays(values, ["item_id", "start", "n"]), doc[each], len(index.docs))})


def _mark(index: Postings, block: int, query: Query, slop: int | None) -> pa.RecordBatch:
    """Of decontaminate() and, with slop, of proximity(): covered spans and the items found; a row for each document."""
    n, total, windows = len(index.docs), len(index.positions), max(1, len(query.sizes))
    change, pairs = np.zeros(total + 1, np.int32), np.zeros(0, np.int64)
    for window, place in search(index, query, slop):
        if slop is None:
            np.add.at(change, place, 1)
            np.add.at(change, place + query.sizes[window], -1)
        pairs = np.unique(np.concatenate([pairs, index.documents(place) * windows + window]))
    item_doc, item = query.pairs(pairs // windows, pairs % windows)
    out = _rows(index, block) | {"items": _lists(item, item_doc, n)}
    if slop is not None:
        return pa.RecordBatch.from_pydict(out)
    covered = np.cumsum(change[:-1]) > 0
    first = covered.copy()
    first[1:] &= ~covered[:-1]
    edges = index.doc_begins[:-1][index.doc_begins[:-1] < index.doc_begins[1:]]
    first[edges] = covered[edges]
    start = np.flatnonzero(first)
    upto = np.concatenate([[0], np.cumsum(covered)])
    size = np.diff(np.append(upto[start], upto[-1]))
    doc = index.documents(start)
    spans = pa.StructArray.from_arrays([pa.array(start - index.doc_begins[doc], pa.int64()), pa.array(size, pa.int64())], ["start", "n"])
    return pa.RecordBatch.from_pydict(out | {"spans": _lists(spans, doc, n)})


_ROW = "block int, row long, doc_id long, n_words long"


def _over(index: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, act, columns: dict[str, str]) -> DataFrame:
    """act(postings, block, query) for each block and each query, the lists of several queries joined; index rows stay where they were written."""
    schema = ", ".join([_ROW, *(f"{k} {v}" for k, v in columns.items())])
    parts = []
    for portions, query in _queries(items, window, id_col, text_col):
        shared = index.sparkSession.sparkContext.broadcast(query)

        def run(batches, shared=shared):
            for batch in batches:
                for k in range(batch.num_rows):
                    scan.trim()
                    yield act(Postings(batch, k), batch.column("block")[k].as_py(), shared.value)

        part = index.mapInArrow(run, schema)
        if portions == 1:
            return part
        parts.append(stored(part))
        shared.destroy()
    every = functools.reduce(DataFrame.union, parts)
    return every.groupBy("block", "row", "doc_id", "n_words").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in columns])


def matches(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per indexed document: doc_id, n_words, hits (item_id, start, n): exact occurrences of the items' windows, or with slop where they stand near.

    The benchmark is the query set and goes over all blocks in portions of bounded size.
    """
    hits = {"hits": "array<struct<item_id: long, start: long, n: long>>"}
    return _over(index, items, window, id_col, text_col, lambda postings, block, query: _match(postings, block, query, slop), hits).select("doc_id", "n_words", "hits")


def proximity(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = SLOP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_near and near (item_ids, sorted as strings): items with a window whose words all stand, in any order, within window + slop consecutive words of the document.

    Windows, nulls and repeated ids as decontaminate() has them.
    """
    found = _over(build_index(docs, id_col, text_col), items, window, "item_id", "text", lambda postings, block, query: _mark(postings, block, query, slop), {"items": "array<long>"})
    out = found.select("doc_id", "n_words", F.array_sort(F.transform(F.array_distinct("items"), lambda i: i.cast("string"))).alias("near"))
    return out.select("doc_id", "n_words", F.size("near").cast("long").alias("n_near"), "near")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside occurrences of windows), n_items, items (sorted as strings), contaminated.

    A window: window consecutive words of an item; an item of fewer, but not none, is one.
    Null texts have no words; null and repeated doc_ids keep a row each; repeated items
    count once; items without an id or text are none.  Other columns are ignored.
    """
    columns = {"items": "array<long>", "spans": "array<struct<start: long, n: long>>"}
    found = _over(build_index(docs, id_col, text_col), items, window, "item_id", "text", lambda postings, block, query: _mark(postings, block, query, None), columns)
    # spans of one query never overlap, those of several may: by their starts, each adds what lies behind the farthest end so far
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    end = lambda s: F.greatest(s["start"] + s["n"], F.lit(0))
    hit = F.aggregate(F.array_sort("spans"), zero, lambda a, s: F.struct(F.greatest(a["end"], end(s)).alias("end"), (a["hit"] + F.greatest(F.lit(0), end(s) - F.greatest(a["end"], s["start"]))).alias("hit")), lambda a: a["hit"])
    names = F.array_sort(F.transform(F.array_distinct("items"), lambda i: i.cast("string")))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), names.alias("items")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", (F.col("n_hit") > 0).alias("contaminated")
    )


#: The contract's rows in DuckDB SQL, over documents and benchmark.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(@LOWER@, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(@LOWER@, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, w[k : k + 9] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT len(win) AS n FROM windows
), places AS (
  SELECT doc_id, n, k, w[k : k + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d JOIN sizes ON len(w) >= n)
), found AS (
  SELECT doc_id, n, k, item_id FROM places JOIN windows USING (win)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, n, k FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""".replace("@LOWER@", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
