"""N-gram Jaccard join: blocked sparse products of document by shingle incidence.

A document's set holds its distinct word shingles.  Two documents can reach the
threshold only if they share a shingle among the n - ceil(t n) + 1 that come first in
each, in an order that all documents agree on; the order here puts rare shingles first,
by their exact document counts (block exchange).  Shingles of one document alone can't
be shared, so only the others of such documents are kept, and overlaps stay exact.

Documents that share a leading shingle with the smallest id that has it form a cluster.
Clusters are cut into tiles; the product of a tile's incidence matrix with its
transpose, block of columns by block, adds up overlaps, and rows without a partner in
reach of the bounds by size and by what is left of the columns go.  A first pass joins
each tile with its pivot, a second one the tiles of large clusters with each other, but
for pairs of documents that the first pass has put in the cluster's main component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.components import connected_components
from pairloom.llm.shared import answers, dropped, exchange, ids_of, in_blocks, n_blocks, RANGE_BYTES, settled, spread, stored, text_bytes

#: Documents and bytes of shingles in a tile, bytes behind a task's group of tiles, and columns multiplied at once.
TILE, TILE_BYTES, BIN_BYTES = 512, 8 << 20, 4 << 20
COLUMNS = 2048
#: Where the node numbers of rows without an id begin.
UNNAMED = 1 << 62


def _sets(table: pa.Table, n: int) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = scan.text_buffer(table.column("text"))
    return scan.distinct_by_text(*scan.ngrams(*scan.word_hashes(flat, offsets, scan.NON_SPACE), n))


def _profiles(table: pa.Table, found: pa.Table, n: int, percent: int) -> pa.Table:
    """Per document: size and digest of its set; for the first of its block with this set, the shared shingles, rare first, and how many of them lead."""
    scan.trim()
    h, owner = _sets(table, n)
    df = answers(found)[scan.classes(h)[2]]
    rows, ids, unnamed = table.num_rows, ids_of(table), table.column("doc_id").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    size = np.bincount(owner, minlength=rows)
    key = np.zeros((rows, 2), np.uint64)
    np.add.at(key[:, 0], owner, scan.mix(h))
    np.add.at(key[:, 1], owner, scan.mix(h ^ np.uint64(0x5851F42D4C957F2D)))
    # rows without an id are nodes by their set, behind all others in order
    ids[unnamed] = (key[unnamed, 0] >> np.uint64(2)).astype(np.int64) | UNNAMED
    first = np.zeros(rows, bool)
    order = np.lexsort((ids, size, key[:, 1], key[:, 0]))
    same = (key[order[1:]] == key[order[:-1]]).all(axis=1) & (size[order[1:]] == size[order[:-1]])
    first[order[np.concatenate([[True], ~same])] if rows else order] = True
    leads = size - (size * percent + 99) // 100 + 1 - np.bincount(owner[df < 2], minlength=rows)
    keep = (df >= 2) & (first & (leads > 0))[owner]
    h, owner, df = h[keep], owner[keep], df[keep]
    order = np.lexsort((h, df, owner))
    h, edges = h[order], np.searchsorted(owner[order], np.arange(rows + 1))
    shared = [h[edges[i] : edges[i + 1]] for i in range(rows)]
    return pa.table({
        "doc_id": pa.array(ids, pa.int64()), "unnamed": pa.array(unnamed), "n_shingles": pa.array(size, pa.int64()),
        "key_a": pa.array(key[:, 0].view(np.int64), pa.int64()), "key_b": pa.array(key[:, 1].view(np.int64), pa.int64()),
        "shared": pa.array([x.tobytes() if len(x) else None for x in shared], pa.binary()),
        "leading": pa.array([x[: max(0, k)].view(np.int64).tolist() for x, k in zip(shared, leads, strict=True)], pa.list_(pa.int64())),
    })


def overlaps(sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows with 100 * overlap >= percent * union: the blocked product of the incidence matrix and its transpose."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    names, cols, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    cols, rows = cols[(many := counts[cols] > 1)], rows[many]
    order = np.argsort(cols, kind="stable")
    _, cols = np.unique(cols[order], return_inverse=True)
    rows = rows[order]
    live = np.arange(len(sets))
    total, left = np.zeros((len(sets), len(sets)), np.float32), np.bincount(rows, minlength=len(sets)).astype(np.float32)
    width = int(cols[-1]) + 1 if len(cols) else 0
    at = np.searchsorted(cols, np.arange(0, width + COLUMNS, COLUMNS))
    need = percent * (sizes[:, None] + sizes[None, :]) / (100 + percent)
    need[sizes[:, None] * percent > sizes[None, :] * 100] = np.inf  # sizes too far apart
    need = np.maximum(need, need.T)
    np.fill_diagonal(need, np.inf)
    for a, b in zip(at[:-1], at[1:], strict=True):
        reach = total + np.minimum(left[live][:, None], left[live][None, :]) >= need[np.ix_(live, live)] - 0.5
        keep = reach.any(axis=1)
        live, total = live[keep], total[np.ix_(keep, keep)]
        if not len(live):
            return live, live
        place = np.full(len(sets), -1)
        place[live] = np.arange(len(live))
        r, c = place[rows[a:b]], cols[a:b] - cols[a]
        left -= np.bincount(rows[a:b], minlength=len(sets))
        part = np.zeros((len(live), COLUMNS), np.float32)
        part[r[r >= 0], c[r >= 0]] = 1
        total += part @ part.T
    i, j = np.nonzero(np.triu(total > 0, 1) & np.isfinite(need[np.ix_(live, live)]))
    both = total[i, j].astype(np.int64)
    i, j = live[i], live[j]
    linked = 100 * both >= percent * (sizes[i] + sizes[j] - both)
    return i[linked], j[linked]


def _forest(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row linked with each row, directly or by others."""
    root = np.arange(count)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _tile_edges(table: pa.Table, percent: int) -> pa.Table:
    scan.trim()
    table = table.sort_by([("pivot", "ascending"), ("tile", "ascending"), ("doc", "ascending")])
    pivot, tile, doc, size = (table.column(k).to_numpy() for k in ("pivot", "tile", "doc", "n_shingles"))
    edges = np.flatnonzero(np.concatenate([[True], (pivot[1:] != pivot[:-1]) | (tile[1:] != tile[:-1]), [True]]))
    shared = table.column("shared")
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in shared.slice(a, b - a)]
            root = _forest(b - a, *overlaps(size[a:b].astype(np.float64).astype(np.int64), sets, percent))
            moved = np.flatnonzero(root != np.arange(b - a))
            out.append((doc[a:b][root[moved]], doc[a:b][moved]))
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else ((), ())))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _products(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Spanning edges of the links within each (pivot, tile) of members (pivot, tile, doc, bytes)."""
    total = members.agg(F.sum("bytes")).first()[0] or 0
    bins = max(members.sparkSession.sparkContext.defaultParallelism, -(-total // BIN_BYTES))
    full = members.select("pivot", "tile", "doc").join(reps.select("doc", "n_shingles", "shared"), "doc")
    full = spread(full.withColumn("bin", F.pmod(F.xxhash64("pivot", "tile"), F.lit(bins))), "bin", bins)
    return full.groupBy("bin").applyInArrow(lambda table: _tile_edges(table, percent), "a long, b long")


def _tiles(open_) -> Column:
    """How many tiles hold the members where open_ holds, by their number and their bytes."""
    return F.greatest(F.ceil(F.count_if(open_) / TILE), F.ceil(F.sum(F.when(open_, F.col("bytes"))) / TILE_BYTES)).cast("long")


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Documents link when 100 * intersection >= percent * union of their sets of n-word
    shingles (A-Z lower-cased, words between ASCII white space).  Fewer than n words make
    one shingle; null, empty and blank texts have an empty set and link with nothing.  Rows
    without a doc_id take part in links and are returned with nulls; rows that repeat a doc_id
    are one node, whose component all their sets' links make.  Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    settled(spark)
    total = text_bytes(docs, text_col)
    blocks, ranges = n_blocks(spark, total), max(16, -(-total // RANGE_BYTES))
    dealt = in_blocks(docs, blocks, id_col, text_col)

    def features(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return scan.counted(_sets(table, n)[0])

    found = exchange(dealt, blocks, ranges, features)
    profiles = stored(
        spread(dealt, "block", blocks).groupBy("block").cogroup(spread(found, "block", blocks).groupBy("block")).applyInArrow(
            lambda left, right: _profiles(left, right, n, percent),
            "doc_id long, unnamed boolean, n_shingles long, key_a long, key_b long, shared binary, leading array<long>",
        )
    )
    dropped(found)
    classes = stored(profiles.filter("n_shingles > 0").groupBy("key_a", "key_b", "n_shingles").agg(F.min("doc_id").alias("rep")))
    heads = classes.select(F.col("rep").alias("doc"))
    reps = stored(profiles.filter("shared is not null").withColumnRenamed("doc_id", "doc").join(heads, "doc", "left_semi").select("doc", "n_shingles", "shared", "leading"))
    postings = stored(reps.select("doc", F.octet_length("shared").alias("bytes"), F.explode("leading").alias("shingle")))
    pivots = postings.groupBy("shingle").agg(F.min("doc").alias("pivot"), F.count("*").alias("c")).filter("c > 1").select("shingle", "pivot")
    stars = stored(postings.join(pivots, "shingle").select("pivot", "doc", "bytes").distinct())

    tiles = stars.groupBy("pivot").agg(_tiles(F.lit(True)).alias("tiles")).filter("tiles > 0")
    tiled = stored(stars.join(tiles, "pivot").withColumn("tile", F.pmod(F.xxhash64("doc"), "tiles")))
    dropped(postings, stars)
    heads = tiled.filter("tiles > 1").select("pivot", "tile").distinct().select("pivot", "tile", F.col("pivot").alias("doc"), F.lit(0).alias("bytes"))
    edges = stored(_products(tiled.select("pivot", "tile", "doc", "bytes").union(heads).dropDuplicates(["pivot", "tile", "doc"]), reps, percent))

    large = tiled.filter("tiles > 1")
    if large.take(1):
        known = connected_components(edges)
        large = stored(large.join(known.withColumnRenamed("node", "doc"), "doc", "left").select("pivot", "doc", "bytes", F.coalesce("component", "doc").alias("component")))
        sizes = large.groupBy("pivot", "component").count()
        main = sizes.groupBy("pivot").agg(F.max_by("component", F.struct("count", "component")).alias("main"))
        large = large.join(main, "pivot").withColumn("open", F.col("component") != F.col("main"))
        counts = large.groupBy("pivot").agg(F.coalesce(_tiles(F.col("open")), F.lit(0)).alias("n_open"), F.coalesce(_tiles(~F.col("open")), F.lit(0)).alias("n_main")).filter("n_open > 0")
        large = large.join(counts, "pivot").withColumn("t", F.pmod(F.xxhash64("doc"), F.when(F.col("open"), F.col("n_open")).otherwise(F.col("n_main"))))
        # tile pairs: (open i, open j >= i) and (open i, main j), numbered i * (n_open + n_main) + j
        wide = F.col("n_open") + F.col("n_main")
        own = F.transform(F.sequence(F.col("t"), wide - 1), lambda j: F.col("t") * wide + j)
        other = F.when(F.col("t") > 0, F.transform(F.sequence(F.lit(0).cast("long"), F.col("t") - 1), lambda i: i * wide + F.col("t"))).otherwise(F.array().cast("array<long>"))
        mains = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n_open") - 1), lambda i: i * wide + F.col("n_open") + F.col("t"))
        pairs = large.select("pivot", "doc", "bytes", F.explode(F.when(F.col("open"), F.concat(own, other)).otherwise(mains)).alias("tile")).distinct()
        edges = stored(edges.union(_products(stored(pairs.select("pivot", "tile", "doc", "bytes")), reps, percent)))

    # an id that several sets have ties their classes
    sets = profiles.filter("n_shingles > 0").select("doc_id", "key_a", "key_b", "n_shingles")
    repeated = sets.groupBy("doc_id").agg(F.min("key_a").alias("x"), F.max("key_a").alias("y")).filter("x <> y").select("doc_id")
    ties = sets.join(repeated, "doc_id").join(classes, ["key_a", "key_b", "n_shingles"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comps = connected_components(edges.union(ties)).withColumnRenamed("node", "rep")
    classes = classes.join(comps, "rep", "left").select("key_a", "key_b", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    out = profiles.select("doc_id", "unnamed", "n_shingles", "key_a", "key_b").join(classes, ["key_a", "key_b", "n_shingles"], "left")
    named = lambda c: F.when(~F.col("unnamed"), c)
    return out.select(named(F.col("doc_id")).alias("doc_id"), "n_shingles", named(F.coalesce("component_id", "doc_id")).alias("component_id"))


#: The same in DuckDB SQL, over documents.
SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(@LOWER@, '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k : k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT DISTINCT a AS doc_id, a AS root FROM both_ways UNION SELECT b, root FROM reach JOIN both_ways ON a = doc_id
), least AS (
  SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(coalesce(component_id, doc_id), doc_id) AS component_id FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
""".replace("@LOWER@", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
