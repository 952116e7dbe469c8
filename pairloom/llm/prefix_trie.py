"""The prefix trie of conversations, read off a Cartesian tree over the LCP array of the sorted conversations.

A conversation becomes the digests of its turns, one after the other, so that conversations
sort by their turns and equal prefixes stand together.  Equal conversations are summed up to one
row; the distinct ones are range-sorted into blocks.  LCP[i] is the number of turns that row i shares
with row i - 1.  A trie node of depth d whose first row is i is the run of rows from i to before the
next j with LCP[j] < d, and i itself has LCP[i] < d: all nodes follow from the nearest smaller
values on both sides.  Positions with one LCP value and one smaller value to the left are one
node of the Cartesian tree, which stands for all depths from its parent's on; those are expanded.

Blocks do this on their own.  What has no smaller value on one side within its block crosses
its border: at most LCP-many nodes a border, so rows of crossing nodes are few.  Each block gives a
part of them; the block in which such a node begins is the nearest earlier one whose least LCP is
smaller than its depth, found over the array of block minima.  Parts are then added up by that
block and depth.  Counts are sums over intervals, so no node ever holds its members.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import dropped, settled, sized_join, spread, stored

#: Distinct conversations of a block, and blocks for each core at least.
BLOCK, EACH = 50_000, 16
#: Conversations that share a base, and the modulus of the number of turns taken from it.
BASE, HEADS = 100, 6
#: Bytes of a turn's digest, and of a blob of ids.
WIDE, BLOB = 16, 1 << 18
EMPTY = hashlib.sha256(b"").hexdigest()

_NODE = "kind string, block int, depth long, conv_id long, n_convs long, n_children long, n_leaves long, turned long, first_seen long, prefix long, saved_tokens long, ends_sha256 string, parent_conv_id long, parent_side string"


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turns) of rows (conv_id, turn, role, text): turns of (digest, chars) by turn, null first, equal ones by their digests.  Rows without a conv_id belong to no conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # the length keeps (ab, c) and (a, bc) apart
    digest = F.unhex(F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDE))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(text).alias("chars"))
    grouped = rows.filter("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars"))).alias("turns"))


def heads_taken(conv_id: str = "conv_id") -> Column:
    return (F.crc32(F.col(conv_id).cast("string")) % HEADS).cast("int")


def rebuilt(convs: DataFrame) -> DataFrame:
    """(conv_id, key, chars) of stored (conv_id, turns): each conversation begins with the first h turns of its base, and goes on after its own first h.  key holds the turns' digests one after the other, chars their lengths."""
    base = F.col("conv_id") - F.col("conv_id") % BASE
    heads = stored(convs.filter(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")))
    joined = sized_join(convs.withColumn("base", base), heads, "base", row_bytes=64 + 24 * HEADS)
    h, none = heads_taken(), F.array().cast("array<struct<digest:binary,chars:int>>")
    turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), h), F.slice("turns", h + 1, F.greatest(F.lit(0), F.size("turns") - h)))
    out = joined.select("conv_id", turns.alias("t"))
    return out.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["digest"])), "")).alias("key"), F.transform("t", lambda x: x["chars"]).alias("chars"))


def ends(members: DataFrame, distinct: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the keys that several conversations have: SHA-256 of their ids in order.

    By contract that is one stream of bytes.  Members are range-sorted by key and id, so those of one key lie in
    several ranges; each range packs its part as text, whole keys are hashed at once, and parts
    go as blobs to one task, which reads them in order and holds one at a time.
    """
    many = distinct.filter("n > 1").select("key", "n")
    rows = members.select("key", "conv_id").join(many, "key").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def pack(batches):
        key, begun, text, size, seen, total = None, None, [], 0, 0, 0

        def blob(whole):
            data = ",".join(text).encode()
            return (key, begun, None, hashlib.sha256(data).hexdigest()) if whole else (key, begun, data, None)

        for batch in batches:
            out = []
            for k, c, n in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), batch.column("n").to_pylist(), strict=True):
                if k != key or size >= BLOB:
                    if text:
                        out.append(blob(seen == total == len(text)))
                    seen = 0 if k != key else seen
                    key, begun, text, size, total = k, c, [], 0, n
                text.append(str(c))
                size += len(text[-1]) + 1
                seen += 1
            yield _blobs(out)
        if text:
            yield _blobs([blob(seen == total == len(text))])

    found = stored(rows.mapInArrow(pack, "key binary, begun long, data binary, ends_sha256 string"))

    def stream(batches):
        key, sha = None, None
        for batch in batches:
            out = []
            for k, data in zip(batch.column("key").to_pylist(), batch.column("data").to_pylist(), strict=True):
                if k != key:
                    out += [(key, sha.hexdigest())] if sha else []
                    key, sha = k, hashlib.sha256(data)
                else:
                    sha.update(b"," + data)
            yield _ended(out)
        if sha:
            yield _ended([(key, sha.hexdigest())])

    parts = found.filter("data is not null").select("key", "begun", "data").repartition("key").sortWithinPartitions("key", "begun").select("key", "data")
    return found.filter("data is null").select("key", "ends_sha256").union(parts.mapInArrow(stream, "key binary, ends_sha256 string"))


def _blobs(rows: list) -> pa.RecordBatch:
    key, begun, data, sha = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_pydict({"key": pa.array(key, pa.binary()), "begun": pa.array(begun, pa.int64()), "data": pa.array(data, pa.binary()), "ends_sha256": pa.array(sha, pa.string())})


def _ended(rows: list) -> pa.RecordBatch:
    key, sha = zip(*rows, strict=True) if rows else ((), ())
    return pa.RecordBatch.from_pydict({"key": pa.array(key, pa.binary()), "ends_sha256": pa.array(sha, pa.string())})


def common_turns(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Turns that rows a and b share from the first on; words has a row of two for each turn."""
    out, live, most = np.zeros(len(a), np.int64), np.arange(len(a)), np.minimum(sizes[a], sizes[b])
    d = 0
    while len(live := live[most[live] > d]):
        live = live[(words[begins[a[live]] + d] == words[begins[b[live]] + d]).all(axis=1)]
        out[live] += 1
        d += 1
    return out


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the nearest one before with a smaller value, -1 if none, and the nearest one after, len(values) if none."""
    n = len(values)
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    open_: list[int] = []
    for i, v in enumerate(values.tolist()):
        while open_ and open_[-1][1] > v:
            after[open_.pop()[0]] = i
        if open_:
            # equal values are open too: the one before has its smaller value already
            before[i] = before[open_[-1][0]] if open_[-1][1] == v else open_[-1][0]
        open_.append((i, v))
    return before, after


def nearest_block(minima: np.ndarray, block: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """The last block before each given one whose minimum is under the depth: a walk along the nearest smaller minima."""
    before = nearest_smaller(minima)[0]
    at = block - 1
    live = np.flatnonzero(minima[at] >= depth)
    while len(live):
        at[live] = before[at[live]]
        live = live[minima[at[live]] >= depth[live]]
    return at


class _Least:
    """Least values of intervals, from the least values of runs of 1, 2, 4... places."""

    def __init__(self, values: np.ndarray):
        self.table = [values]
        while len(self.table[-1]) > (step := 1 << len(self.table) - 1):
            self.table.append(np.minimum(self.table[-1][:-step], self.table[-1][step:]))

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        out, power = np.zeros(len(begin), np.int64), np.frexp((end - begin).astype(float))[1] - 1
        for k in np.unique(power):
            at = np.flatnonzero(power == k)
            out[at] = np.minimum(self.table[k][begin[at]], self.table[k][end[at] - (1 << int(k))])
        return out


def block_nodes(rows: pa.Table, left: bytes | None, right: bytes | None, block: int) -> pa.Table:
    """The nodes (_NODE) of one block of sorted distinct conversations (key, chars, conv_id, n, ends_sha256), whose neighbours outside are left and right.

    kind is whole for nodes that lie within the block, left for a part of a node that began in an
    earlier block and right for one that begins here and goes on in the next.  A parent within the block
    is given by its conv_id, one that crosses a border by its side; its depth is the node's less one.
    """
    keys = rows.column("key").to_pylist()
    m = len(keys)
    flat = b"".join([left or b"", *keys, right or b""])
    words = np.frombuffer(flat, "<u8").reshape(-1, 2)
    sizes = np.array([len(left or b""), *map(len, keys), len(right or b"")], np.int64) // WIDE
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    at = np.arange(m + 1)
    lcp = common_turns(words, begins, sizes, at, at + 1)
    lcp[0], lcp[m] = lcp[0] if left is not None else -1, lcp[m] if right is not None else -1
    size = sizes[1:-1]
    convs, n = rows.column("conv_id").to_numpy(), rows.column("n").to_numpy()
    shas = np.array(rows.column("ends_sha256").to_pylist(), object)
    # lengths of a row's first d turns, d from 0
    chars = np.concatenate([[0], np.cumsum(np.array([c for row in rows.column("chars").to_pylist() for c in row], np.int64))])
    origin = np.concatenate([[0], np.cumsum(size)[:-1]])
    prefix = lambda i, d: chars[origin[i] + np.maximum(d, 0)] - chars[origin[i]]
    total = prefix(np.arange(m), size)
    fresh = total - prefix(np.arange(m), lcp[:m])
    run = lambda x: np.concatenate([[0], np.cumsum(x)])
    sum_n, sum_turned, sum_fresh, sum_leaves, least = run(n), run(n * total), run(fresh), run(size > lcp[1:]), _Least(convs)
    before, after = nearest_smaller(lcp)  # over the m + 1 values; m stands for what follows the block

    def part(i: np.ndarray, first: np.ndarray, end: np.ndarray, depth: np.ndarray, begins_here: bool) -> dict:
        """What rows first to end - 1 give to the nodes of a depth; where the node begins with row i, its first turns are seen there."""
        return {
            "depth": depth, "conv_id": least.of(first, end), "n_convs": sum_n[end] - sum_n[first], "n_leaves": sum_leaves[end] - sum_leaves[first], "turned": sum_turned[end] - sum_turned[first],
            "first_seen": sum_fresh[end] - sum_fresh[first + begins_here] + (total[i] - prefix(i, depth - 1) if begins_here else 0), "prefix": prefix(i, depth - 1),
            "ends_sha256": np.where(size[i] == depth, shas[i], EMPTY) if begins_here else np.full(len(depth), EMPTY, object),
        }

    def expand(begin: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and depths begin to last."""
        times = np.maximum(last - begin + 1, 0)
        which = np.repeat(np.arange(len(times)), times)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + begin[which]

    tables = []

    def put(kind: str, columns: dict, children: np.ndarray, parent: np.ndarray, side: np.ndarray) -> None:
        rows_ = len(children)
        saved = columns["turned"] - columns["n_convs"] * columns["prefix"] - columns["first_seen"]
        tables.append(pa.table({
            "kind": pa.array([kind] * rows_, pa.string()), "block": pa.array(np.full(rows_, block), pa.int32()), **{c: pa.array(columns[c].astype(np.int64)) for c in ("depth", "conv_id", "n_convs")}, "n_children": pa.array(children.astype(np.int64)),
            **{c: pa.array(columns[c].astype(np.int64)) for c in ("n_leaves", "turned", "first_seen", "prefix")}, "saved_tokens": pa.array(saved.astype(np.int64)), "ends_sha256": pa.array(columns["ends_sha256"], pa.string()),
            "parent_conv_id": pa.array(np.where(side == "", parent, 0).astype(np.int64), mask=side != ""), "parent_side": pa.array(side, pa.string()),
        }))

    def parents(start: np.ndarray, end: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """conv_id and side of the nodes of depth top that hold rows start to end - 1 and more."""
        s = np.where(lcp[start] < top, start, before[start])
        e = np.where(lcp[np.minimum(end, m)] < top, end, after[np.minimum(end, m)])
        side = np.where(top < 0, "none", np.where(s < 0, "left", np.where(e > m, "right", ""))).astype(object)
        found, own = np.zeros(len(start), np.int64), np.flatnonzero(side == "")
        found[own] = least.of(s[own], e[own])
        return found, side

    # nodes of the Cartesian tree that lie within the block: equal values with one smaller value before are one
    inner = np.arange(1, m)
    inner = inner[(before[inner] >= 0) & (after[inner] <= m)]
    code = before[inner] * (int(lcp.max(initial=0)) + 2) + lcp[inner]
    _, first, equals = np.unique(code, return_index=True, return_counts=True)
    tree = inner[first]
    rows_of = np.arange(m)
    start, end = np.concatenate([before[tree], rows_of]), np.concatenate([after[tree], rows_of + 1])
    deepest = np.concatenate([lcp[tree], size])
    branches = np.concatenate([equals, np.zeros(m, np.int64)])
    top = np.maximum(lcp[start], lcp[end])
    which, depth = expand(top + 1, deepest)
    i, e = start[which], end[which]
    columns = part(i, i, e, depth, True)
    parent, side = parents(start, end, top)
    highest = depth == top[which] + 1
    deep = (depth == deepest[which]) & (which < len(tree))
    children = np.where(deep, branches[which] + (size[i] > depth), size[i] > depth)
    put("whole", columns, children, np.where(highest, parent[which], columns["conv_id"]), np.where(highest, side[which], "").astype(object))

    # nodes that begin here and go on: rows whose value is under all that follow
    rest = np.minimum.accumulate(lcp[::-1])[::-1]
    stairs = np.flatnonzero(lcp[:m] < rest[1:])
    which, depth = expand(lcp[stairs] + 1, rest[stairs + 1])
    i = stairs[which]
    columns = part(i, i, np.full(len(i), m), depth, True)
    level = np.flatnonzero(lcp[:m] == rest[:m])  # values that are the least from there on
    at_depth = np.bincount(lcp[level[lcp[level] >= 0]], minlength=int(depth.max(initial=0)) + 1)
    # a row that is the first step of a lower node is counted by it; its own depth lies below
    children = at_depth[depth] + (size[i] > depth)
    highest = depth == lcp[i] + 1
    side = np.where(~highest, "right", np.where(depth == 0, "none", np.where(before[i] < 0, "left", "right"))).astype(object)
    put("right", columns, children, np.zeros(len(i)), side)

    # parts of nodes that began before
    depth = np.arange(0, lcp[0] + 1)
    until = np.minimum.accumulate(lcp)
    ends_at = np.minimum(np.searchsorted(-until, -depth, "right"), m)  # the first value under the depth
    columns = part(np.zeros(len(depth), np.int64), np.zeros(len(depth), np.int64), ends_at, depth, False)
    low = np.flatnonzero((lcp[:m] == until[:m]) & (lcp[:m] >= 0))
    put("left", columns, np.bincount(lcp[low], minlength=len(depth))[: len(depth)], np.zeros(len(depth)), np.full(len(depth), "none", object))

    tables.append(pa.table({"kind": ["least"], "block": pa.array([block], pa.int32()), "depth": pa.array([int(lcp[:m].min())])}))
    return pa.concat_tables(tables, promote_options="default").select([c.split()[0] for c in _NODE.split(", ")])


def _begun_in(rows: DataFrame, minima: np.ndarray) -> DataFrame:
    """rows with home: the block in which a node of this block and depth began, for parts on the left; else the block itself."""

    def find(batches):
        for batch in batches:
            block, depth = batch.column("block").to_numpy().astype(np.int64), batch.column("depth").to_numpy()
            left = batch.column("kind").to_numpy(zero_copy_only=False) == "left"
            home = block.copy()
            home[left] = nearest_block(minima, block[left], depth[left])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home)], names=[*batch.schema.names, "home"])

    return rows.mapInArrow(find, f"{_NODE}, home long")


def trie_of(members: DataFrame) -> DataFrame:
    """The nodes of the trie of stored members (conv_id, key, chars), a row for each distinct prefix."""
    spark = members.sparkSession
    distinct = stored(members.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("chars").alias("chars")))
    total = distinct.count()
    blocks = max(EACH * spark.sparkContext.defaultParallelism, -(-total // BLOCK))
    hashed = stored(ends(members, distinct))
    single = distinct.filter("n = 1").withColumn("ends_sha256", F.sha2(F.col("conv_id").cast("string"), 256))
    several = sized_join(distinct.filter("n > 1"), hashed, "key", "inner", row_bytes=512)
    ordered = single.unionByName(several).repartitionByRange(blocks, "key").sortWithinPartitions("key")
    # the blocks are written, as two plans of one ranging need not agree on the bounds
    ordered = stored(ordered.withColumn("_at", F.monotonically_increasing_id())).withColumn("block", F.shiftright("_at", 33).cast("int"))
    dropped(distinct, hashed)
    edges = ordered.groupBy("block").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    # a number for each block that has rows
    numbered = [(r.block, k) for k, r in enumerate(edges.select("block").orderBy("block").collect())]
    if not numbered:
        return ordered.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    known = F.broadcast(spark.createDataFrame(numbered, "block int, k int"))
    edges = stored(edges.join(known, "block").drop("block"))
    beside = edges.select("k").join(edges.select((F.col("k") + 1).alias("k"), F.col("last").alias("left")), "k", "left").join(edges.select((F.col("k") - 1).alias("k"), F.col("first").alias("right")), "k", "left")
    n = len(numbered)

    def nodes(key, rows: pa.Table, around: pa.Table) -> pa.Table:
        around = around.slice(0, 1).to_pylist()[0]
        return block_nodes(rows.sort_by("_at"), around["left"], around["right"], key[0].as_py())

    parts = stored(spread(ordered.join(known, "block").drop("block"), "k", n).groupBy("k").cogroup(spread(beside, "k", n).groupBy("k")).applyInArrow(nodes, _NODE))
    minima = np.zeros(n, np.int64)
    for r in parts.filter("kind = 'least'").select("block", "depth").collect():  # a number for each block
        minima[r.block] = r.depth
    crossing = stored(_begun_in(parts.filter("kind IN ('left', 'right')"), minima))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "turned", "first_seen")]
    opens = lambda c: F.max(F.when(F.col("kind") == "right", F.col(c))).alias(c)
    whole = stored(crossing.groupBy("home", "depth").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("prefix").alias("prefix"), opens("ends_sha256"), opens("parent_side")))
    # every block's view of the nodes that cross its borders
    seen = stored(crossing.select("block", "depth", F.col("kind").alias("side"), "home").join(whole.select("home", "depth", "conv_id"), ["home", "depth"]).select("block", F.col("depth").alias("above"), "side", F.col("conv_id").alias("found")))
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    own = parts.filter("kind = 'whole'").select("block", "parent_side", *columns)
    across = whole.select(F.col("home").cast("int").alias("block"), "parent_side", "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", (F.col("turned") - F.col("n_convs") * F.col("prefix") - F.col("first_seen")).alias("saved_tokens"), "ends_sha256")
    every = own.unionByName(across)
    closed = every.filter("parent_side IN ('', 'none')").select(*columns)
    open_ = every.filter("parent_side IN ('left', 'right')").withColumn("above", F.col("depth") - 1).withColumnRenamed("parent_side", "side")
    joined = sized_join(open_, seen, ["block", "above", "side"], "inner")
    return closed.unionByName(joined.withColumn("parent_conv_id", F.col("found")).select(*columns))


def prefix_trie(rows: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, from rows (conv_id, turn, role, text):
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A null role or text is empty; turns go by number, null first, and those of one number by their digests, so
    repeated rows are repeated turns.  Rows with a null conv_id are left out.  A table without
    conversations has no nodes, not even a root.  A conversation's digests (16 bytes a turn) are held together, its
    texts are not.
    """
    settled(rows.sparkSession)
    convs = stored(conversations(rows))
    members = stored(rebuilt(convs))
    dropped(convs)
    return trie_of(members)


SQL = r"""
WITH turns AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS own,
         (xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 6)::BIGINT AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS t FROM turns c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 100
), prefixes AS (
  SELECT conv_id, len(t) AS size, unnest(range(0, len(t) + 1)) AS depth, t FROM rebuilt
), named AS (
  SELECT conv_id, size, depth, CASE WHEN depth = 0 THEN 0 ELSE length(t[depth].t) END AS chars, sha256(to_json(t[1:depth])::VARCHAR) AS node, CASE WHEN depth > 0 THEN sha256(to_json(t[1:depth - 1])::VARCHAR) END AS parent FROM prefixes
), nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth), '') AS ended FROM named GROUP BY node
), children AS (
  SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
), below AS (
  SELECT DISTINCT a.node, b.node AS under FROM named a JOIN named b ON a.conv_id = b.conv_id AND a.depth <= b.depth
), sums AS (
  SELECT b.node, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens FROM below b JOIN nodes u ON u.node = b.under LEFT JOIN children c ON c.node = b.under GROUP BY b.node
)
SELECT x.conv_id, x.depth, p.conv_id AS parent_conv_id, x.n_convs, coalesce(c.n, 0) AS n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(x.ended) AS ends_sha256
FROM nodes x LEFT JOIN nodes p ON p.node = x.parent LEFT JOIN children c ON c.node = x.node JOIN sums ON sums.node = x.node
"""
