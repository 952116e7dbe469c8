"""Sequence clusters: all pairs that exact bounds leave are aligned, identity and coverage decide, a greedy cover picks representatives."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.keys import positions, saved

#: Sequences in a block; every two blocks are a tile of their own.
BLOCK = 512
#: Pairs that are aligned at once, the longest sequence of theirs, and the bits of a place in one.
AT_ONCE, LONGEST, BITS = 8192, 32767, 15


def align(a: str, b: str) -> tuple[float, float, float]:
    """Identity of the best local alignment (match 2, mismatch -1, gap -2) and its coverage of both sequences.

    Cells of one diagonal don't depend on each other, so each diagonal is one pass over
    arrays, in memory linear in the length.  Of equal steps the diagonal one goes before a gap in b, and
    that before a gap in a; of equal alignments the one that ends first in a, then in b.
    """
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    n, m = len(x), len(y)
    if not n or not m:
        return 0.0, 0.0, 0.0
    # by place in a: score, first places in a and b, and matches of the best alignment that ends in a cell of each of the last two diagonals
    before, last = np.zeros((4, n + 1), np.int64), np.zeros((4, n + 1), np.int64)
    best, end = np.zeros(4, np.int64), (0, 0)
    for d in range(2, n + m + 1):
        i = np.arange(max(1, d - m), min(n, d - 1) + 1)
        j = d - i
        hit = x[i - 1] == y[j - 1]
        scores = np.stack([before[0, i - 1] + np.where(hit, 2, -1), last[0, i - 1] - 2, last[0, i] - 2])
        way, top = scores.argmax(axis=0), scores.max(axis=0)
        went = before[:, i - 1]
        went[1:] = np.where(went[0] == 0, np.stack([i - 1, j - 1, np.zeros_like(i)]), went[1:])
        went[3] += hit
        now = np.where(way == 0, went, np.where(way == 1, last[:, i - 1], last[:, i]))
        now[0] = top
        now[:, top <= 0] = 0
        k = int(now[0].argmax())
        if now[0, k] > best[0] or (now[0, k] == best[0] > 0 and (int(i[k]), int(j[k])) < end):
            best, end = now[:, k].copy(), (int(i[k]), int(j[k]))
        before, last = last, np.zeros((4, n + 1), np.int64)
        last[:, i] = now
    if not best[0]:
        return 0.0, 0.0, 0.0
    la, lb = end[0] - int(best[1]), end[1] - int(best[2])
    return float(best[3]) / max(la, lb), la / len(a), lb / len(b)


def _padded(seqs: list[bytes], fill: int) -> tuple[np.ndarray, np.ndarray]:
    """Letters (place, sequence) with fill behind each one's end, and the lengths."""
    size = np.array([len(x) for x in seqs], np.int64)
    out = np.full((len(seqs), int(size.max(initial=0))), fill, np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(seqs), np.uint8)
    return np.ascontiguousarray(out.T), size


def align_many(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """align() of each a with its b, as rows (identity, coverage of a, coverage of b); all pairs go through the cells together.

    A cell is one integer: score, way, first places in a and b, matches.  The fillers differ
    and are no letters of UTF-8, so they never match and no best alignment ends in them.
    """
    x, n = _padded(a, 254)
    y, m = _padded(b, 255)
    one, step = 1 << (3 * BITS + 2), 1 << (3 * BITS)
    mask, low = ~np.int64(3 * step), (1 << BITS) - 1
    last, best = np.zeros((len(y) + 1, len(a)), np.int64), np.zeros(len(a), np.int64)
    ends = np.zeros((2, len(a)), np.int64)
    for i, letter in enumerate(x):
        now = np.zeros_like(last)
        for j in range(len(y)):
            diagonal = np.where(last[j] == 0, i << (2 * BITS) | j << BITS, last[j]) + np.where(letter == y[j], 2 * one + 1, -one)
            top = np.maximum(np.maximum(diagonal + 2 * step, last[j + 1] - 2 * one + step), now[j] - 2 * one) & mask
            top[top < one] = 0
            now[j + 1] = top
            better = np.flatnonzero(top >> (3 * BITS + 2) > best >> (3 * BITS + 2))
            best[better] = top[better]
            ends[0, better], ends[1, better] = i + 1, j + 1
        last = now
    la, lb = ends[0] - (best >> (2 * BITS) & low), ends[1] - (best >> BITS & low)
    some = np.maximum(1, np.stack([np.maximum(la, lb), n, m]))
    return np.where(best > 0, np.stack([best & low, la, lb]) / some, 0.0).T


def align_all(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """align_many() for pairs that fit into its cells, align() for the few that are longer."""
    long = np.array([max(len(x), len(y)) > LONGEST for x, y in zip(a, b, strict=True)], bool)
    out = np.zeros((len(a), 3))
    if not long.all():
        fit = np.flatnonzero(~long)
        out[fit] = align_many([a[k] for k in fit], [b[k] for k in fit])
    for k in np.flatnonzero(long):
        out[k] = align(a[k].decode(), b[k].decode())
    return out


def similar_pairs(seqs: DataFrame, identity: float, coverage: float) -> DataFrame:
    """(a, b), a < b, of seqs (id, seq) that reach identity and coverage of both; none is left out.

    The matches of such a pair are identity * coverage of the longer sequence at least, and
    no more than the letters that the two have in common.  Blocks of like lengths are
    compared in tiles, one for each two blocks that this bound leaves.
    """
    rows = seqs.filter("seq <> ''").select("id", "seq", F.octet_length("seq").alias("size"))
    blocks = saved(positions(rows, "size", "id").withColumn("block", F.expr(f"pos div {BLOCK}")).drop("pos"))
    sizes = blocks.groupBy("block").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    x, y = (sizes.select(*[F.col(c).alias(f"{c}_{e}") for c in sizes.columns]) for e in "ij")
    need = identity * coverage * (1 - 1e-9)
    tiles = saved(x.join(y, (F.col("block_i") <= F.col("block_j")) & (F.col("most_i") >= need * F.col("least_j"))).select(F.col("block_i").alias("i"), F.col("block_j").alias("j")))
    dealt = tiles.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block")).join(blocks.drop("size"), "block")

    def compare(key, table):
        block, ids = table.column("block").to_numpy(), table.column("id").to_numpy()
        letters = [x.encode() for x in table.column("seq").to_pylist()]
        counts = np.array([np.bincount(np.frombuffer(x, np.uint8), minlength=256) for x in letters], np.int32)
        size = counts.sum(axis=1)
        counts = counts[:, counts.any(axis=0)]
        left, right = np.flatnonzero(block == key[0].as_py()), np.flatnonzero(block == key[1].as_py())
        found = []
        for p in left:
            q = right[ids[right] != ids[p]]
            if key[0] == key[1]:
                q = q[ids[q] > ids[p]]
            q = q[np.minimum(counts[q], counts[p]).sum(axis=1) >= need * np.maximum(size[q], size[p])]
            found.append(np.stack([np.full(len(q), p), q]))
        pairs = np.concatenate(found, axis=1)
        pairs = pairs[:, np.lexsort((size[pairs[1]], size[pairs[0]]))]
        good = np.zeros(pairs.shape[1], bool)
        for at in range(0, len(good), AT_ONCE):
            p, q = pairs[:, at : at + AT_ONCE]
            some, other = [letters[k] for k in np.where(ids[p] < ids[q], p, q)], [letters[k] for k in np.where(ids[p] < ids[q], q, p)]
            good[at : at + AT_ONCE] = (align_all(some, other) >= (identity, coverage, coverage)).all(axis=1)
        ends = np.sort(ids[pairs[:, good]], axis=0)
        return pa.table({"a": ends[0], "b": ends[1]})

    return dealt.groupBy("i", "j").applyInArrow(compare, "a long, b long")


def greedy_cover(nodes: list[tuple], pairs: list[tuple]) -> dict:
    """Representative of each node (id, length): again and again the one with most partners takes them, then the longer, then the smaller id."""
    partners: dict = {i: set() for i, _ in nodes}
    for a, b in pairs:
        partners[a].add(b)
        partners[b].add(a)
    out: dict = {}
    for i, _ in sorted(nodes, key=lambda x: (-len(partners[x[0]]), -x[1], x[0])):
        if i not in out:
            out[i] = i
            for j in partners[i]:
                out.setdefault(j, i)
    return out


def cover(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(centroid, member) of greedy_cover() for nodes (id, length, copies) and their pairs (a, b); copies of a node count as partners.

    The order is fixed at the start, so a node is a centre if none of its neighbours that
    come before it is one.  Each round settles, everywhere at once, the nodes that come
    before all their open neighbours; rounds are as many as the longest run of open
    neighbours in falling order needs, and each is written once.
    """
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("u", "v")
    gained = both.join(nodes.select(F.col("id").alias("v"), "copies"), "v").groupBy("u").agg(F.sum("copies").alias("more"))
    ranked = nodes.join(gained.withColumnRenamed("u", "id"), "id", "left")
    ranked = saved(ranked.select("id", F.struct((1 - F.col("copies") - F.coalesce("more", F.lit(0))).alias("d"), (-F.col("length")).alias("l"), F.col("id").alias("id")).alias("key")))
    end = lambda c: ranked.select(F.col("id").alias(c), F.col("key").alias(f"k{c}"))
    links = saved(both.join(end("u"), "u").join(end("v"), "v").select("ku", "kv"))
    left, taken = links, links.select(F.col("ku").alias("k")).filter("false")
    while left.take(1):
        centres = left.groupBy("ku").agg(F.min("kv").alias("least")).filter("ku < least").select("ku")
        now = saved(left.join(centres, "ku", "left_semi").select(F.col("kv").alias("k")).distinct())
        gone = now.union(centres.withColumnRenamed("ku", "k"))
        left = saved(left.join(gone.withColumnRenamed("k", "ku"), "ku", "left_anti").join(gone.withColumnRenamed("k", "kv"), "kv", "left_anti").select("ku", "kv"))
        taken = taken.union(now)
    taken = saved(taken)
    owner = links.join(taken.withColumnRenamed("k", "kv"), "kv", "left_anti").groupBy("ku").agg(F.min("kv").alias("kv"))
    return nodes.select(F.col("id").alias("member")).join(owner.select(F.col("ku.id").alias("member"), F.col("kv.id").alias("centroid")), "member", "left").select(F.coalesce("centroid", "member").alias("centroid"), "member")


def easy_cluster(seqs: DataFrame, identity: float = 0.4, coverage: float = 0.8) -> DataFrame:
    """(centroid, member) of greedy_cover() with a row for every sequence; sequences without partners, empty ones and nulls stand for themselves.

    Equal sequences have the same partners and are partners of each other, so the one with
    the smallest id is compared for all.
    """
    texts = saved(seqs.filter("seq <> ''").groupBy("seq").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    pairs = saved(similar_pairs(texts, identity, coverage))
    owners = cover(texts.select("id", F.length("seq").alias("length"), "copies"), pairs).withColumnRenamed("member", "id")
    found = texts.join(owners, "id").select("seq", "centroid")
    return seqs.select(F.col("id").alias("member"), "seq").join(found, "seq", "left").select(F.coalesce("centroid", "member").alias("centroid"), "member")
