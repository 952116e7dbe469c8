"""LM scoring by a weighted backoff automaton of order 3.

The model is a smoothed n-gram: p(w) = (c(w) + 0.5) / (N + 0.5 (V + 1)), p(w | v) = (c(v w) + MU[0] p(w)) /
(c(v) + MU[0]) and p(w | u v) = (c(u v w) + MU[1] p(w | v)) / (c(u v) + MU[1]).  Its automaton has a root and
a state for each word and each pair seen in training.  A state's arcs are the n-grams that go on
from it, each with its log probability; its failure arc leads to the state of the context without
its first word, with weight MU / (c + MU), and from there, if need be, to the root, where
every word, known or not, has an arc.  After each token the state is that of the longest
context seen.  Counts of words, pairs and triples come from all training documents by the
block exchange; each block of documents gets the totals of the n-grams it holds, which is all
of the automaton that its traversal can reach.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import ASKED, RANGE_BYTES, TOLD, answers, ask, bucket_starts, n_blocks, settled, spread, stored, text_bytes, told, totals_of

#: Weight of the shorter context, in counts, for contexts of one and of two words.
MU = (500.0, 5.0)
#: Bytes of text in a block, and passes that the exchange takes: each has its share of the hash ranges, so that no more than that share of the requests is on disk at once.
BLOCK, PASSES = 8 << 20, 2
#: Tokens that one text advances by before it is cut.
SEGMENT = 512

_END = scan.mix(np.array([1], np.uint64))[0]
_START = scan.mix(np.array([2], np.uint64))[0]
_NEXT = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a hash that stay: all but the three for kind and training for words, 56 for longer n-grams, so that a request stays small.
_KEEP = (~np.uint64(7), ~np.uint64(255), ~np.uint64(255))


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, with an end after each text's, and where each text begins."""
    words, begins = scan.word_hashes(*scan.text_buffer(table.column("text")), scan.NON_SPACE)
    n = len(begins) - 1
    out = np.full(len(words) + n, _END, np.uint64)
    out[np.arange(len(words)) + np.repeat(np.arange(n), np.diff(begins))] = words
    return out, begins + np.arange(n + 1)


def _grams(tokens: np.ndarray, begins: np.ndarray) -> list[np.ndarray]:
    """Keys of the word, the pair and the triple that end at each token; bits 1 and 2 tell which.  A text's first token follows a start; only the second has a triple with it."""
    first = begins[:-1]
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[first] = _START
    pairs = scan.mix(before * _NEXT + tokens)
    before[1:] = pairs[:-1]
    triples = scan.mix(before * _NEXT + tokens)
    return [h & keep | np.uint64(2 * kind) for kind, (h, keep) in enumerate(zip((tokens, pairs, triples), _KEEP, strict=True))]


def _features(table: pa.Table, least: int = 0, end: int = 1 << 64) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams, with keys from least up to end, of all texts of a block, and their counts in training texts."""
    tokens, begins = _tokens(table)
    train = np.repeat(table.column("train").combine_chunks().fill_null(False).to_numpy(zero_copy_only=False).astype(np.uint64), np.diff(begins))
    words, pairs, triples = _grams(tokens, begins)
    inside = np.ones(len(tokens), bool)
    inside[begins[:-1]] = False
    ours = lambda x: (x >= np.uint64(least)) & (x <= np.uint64(end - 1))
    every = np.concatenate([(x | train)[ours(x) & there] for x, there in ((words, True), (pairs, True), (triples, inside))])
    del tokens, words, pairs, triples
    every.sort()
    first = np.flatnonzero(np.concatenate([[True], (every[1:] ^ every[:-1]) > 1])) if len(every) else np.zeros(0, np.int64)
    counts = np.add.reduceat(every & np.uint64(1), first) if len(first) else first
    return every[first] & ~np.uint64(1), counts.astype(np.int64)


def _sum_range(table: pa.Table) -> pa.Table:
    """Totals for each block, and in every row the range's count of training words: all (n) and distinct (v)."""
    scan.trim()
    names, total, parts = totals_of(table)
    words, rows = total[(names & np.uint64(6)) == 0], table.num_rows
    return pa.table(told(table, parts) | {"all_words": pa.array([int(words.sum())] * rows, pa.int64()), "distinct_words": pa.array([int((words > 0).sum())] * rows, pa.int64())})


@dataclass(frozen=True)
class Model:
    """What the whole model has in common: training tokens, distinct ones, training texts, weights of the shorter contexts."""

    n: int
    v: int
    starts: int
    mu: tuple[float, float] = MU

    def root(self, words: np.ndarray) -> np.ndarray:
        """Weight of a word's arc at the root."""
        return np.log10((words + 0.5) / (self.n + 0.5 * (self.v + 1)))


@dataclass
class Automaton:
    """The part of the automaton that a block's tokens can reach.

    States: 0 is the root, 1 the start of a text, then words, then pairs.  A state has its depth, its failure
    state and the weight of that arc; an arc has the state it leaves, the one it leads to and
    its weight.  leads names, for each token, the arcs with the token's word that a pair, a word
    and the root before it would have; -1 where there is none.  below is the state before each token.
    """

    depth: np.ndarray
    failure: np.ndarray
    failure_weight: np.ndarray
    source: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    leads: tuple[np.ndarray, np.ndarray, np.ndarray]
    below: np.ndarray

    @classmethod
    def of(cls, model: Model, ids: list[np.ndarray], counts: list[np.ndarray], first: np.ndarray) -> Automaton:
        """From the number of the word, pair and triple that end at each token (-1: none) and their counts; first: each text's first token."""
        where, seen = [], []
        for own, count in zip(ids, counts, strict=True):
            at = np.zeros(int(own.max(initial=-1)) + 1, np.int64)
            there = np.flatnonzero(own >= 0)
            at[own[there][::-1]] = there[::-1]  # the first token of each n-gram
            where.append(at)
            seen.append(count[at].astype(np.float64))
        known = [c > 0 for c in seen]
        word_state = np.where(known[0], 1 + np.cumsum(known[0]), 0)
        words = int(known[0].sum())
        pair_state = np.where(known[1], 1 + words + np.cumsum(known[1]), -1)
        of_word, of_pair = word_state[ids[0]], pair_state[ids[1]]
        below = np.zeros(len(ids[0]), np.int64)
        below[1:] = np.where(of_pair[:-1] >= 0, of_pair[:-1], of_word[:-1])
        last_word = np.zeros(len(ids[0]), np.int64)
        last_word[1:] = of_word[:-1]
        below[first] = last_word[first] = 1
        # states
        pairs = where[1][known[1]]
        held = np.concatenate([[0.0, model.starts], seen[0][known[0]]])
        depth = np.concatenate([[0], np.ones(1 + words, np.int64), np.full(len(pairs), 2)])
        failure = np.concatenate([np.zeros(2 + words, np.int64), of_word[pairs]])
        failure_weight = np.log10(np.concatenate([model.mu[0] / (held + model.mu[0]), model.mu[1] / (seen[1][known[1]] + model.mu[1])]))
        failure_weight[0] = 0.0
        # arcs of the root, of words and of pairs
        root = model.root(seen[0])
        arc2 = np.log10((seen[1][known[1]] + model.mu[0] * 10 ** root[ids[0][pairs]]) / (held[last_word[pairs]] + model.mu[0]))
        triples = where[2][known[2]]
        before = ids[1][triples - 1]
        shorter = np.zeros(len(pair_state))
        shorter[known[1]] = arc2
        arc3 = np.log10((seen[2][known[2]] + model.mu[1] * 10 ** shorter[ids[1][triples]]) / (seen[1][before] + model.mu[1]))
        source = np.concatenate([np.zeros(len(root), np.int64), last_word[pairs], pair_state[before], [-1]])
        target = np.concatenate([word_state, of_pair[pairs], of_pair[triples], [0]])
        weight = np.concatenate([root, arc2, arc3, [0.0]])
        numbers = lambda known, begin: np.where(known, begin + np.cumsum(known) - 1, -1)
        two, three = numbers(known[1], len(root)), numbers(known[2], len(root) + len(pairs))
        lead3 = np.where(ids[2] >= 0, three[ids[2]], -1) if len(three) else np.full(len(ids[0]), -1)
        return cls(depth, failure, failure_weight, source, target, weight, (lead3, two[ids[1]], ids[0]), below)

    def walk(self, begins: np.ndarray) -> np.ndarray:
        """The weight of each token's step, for texts that begin at begins (n + 1): from left to right with one state for each text.

        A step tries the state's arc; without one it takes the failure arc and tries there, down
        to the root, which has all.  Texts advance together; longer ones than SEGMENT tokens go in segments,
        each from the state before it, which the two tokens before tell.
        """
        sizes = np.diff(begins)
        parts = -(-sizes // SEGMENT)
        start = np.repeat(begins[:-1], parts) + SEGMENT * (np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts))
        size = np.minimum(SEGMENT, np.repeat(begins[1:], parts) - start)
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        state, out = self.below[start], np.zeros(int(begins[-1]))
        for k in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -k, "left"))
            at, now, total = start[:live] + k, state[:live], np.zeros(live)
            taken = np.full(live, -1)
            for level, lead in zip((2, 1, 0), self.leads, strict=True):
                arc = lead[at]
                hit = (taken < 0) & (self.source[arc] == now)
                taken[hit] = arc[hit]
                lost = np.flatnonzero((taken < 0) & (self.depth[now] == level))
                total[lost] += self.failure_weight[now[lost]]
                now[lost] = self.failure[now[lost]]
            out[at] = total + self.weight[taken]
            state[:live] = self.target[taken]
        return out


def _score(table: pa.Table, found: pa.Table, model: Model) -> pa.Table:
    scan.trim()
    tokens, begins = _tokens(table)
    first = begins[:-1]
    inside = np.ones(len(tokens), bool)
    inside[first] = False
    grams = _grams(tokens, begins)
    grams[2] = grams[2][inside]
    names, ids = [], []
    for g in grams:
        known, _, which = scan.classes(g)
        names.append(known)
        ids.append(which)
    every, totals = np.sort(np.concatenate(names)), answers(found)
    counts = [totals[np.searchsorted(every, known)][which] for known, which in zip(names, ids, strict=True)]
    del tokens, grams, names, every, totals
    for own, none in ((ids, -1), (counts, 0)):
        whole = np.full(len(inside), none, np.int64)
        whole[inside] = own[2]
        own[2] = whole
    steps = Automaton.of(model, ids, counts, first).walk(begins)
    return pa.table({
        "doc_id": table.column("doc_id"), "train": table.column("train"), "n_tokens": pa.array(np.diff(begins), pa.int64()),
        "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), first), pa.int64()), "train_tokens": pa.array(np.full(len(first), model.n), pa.int64()),
        "base_score": pa.array(np.add.reduceat(model.root(counts[0]), first), pa.float64()), "score": pa.array(np.add.reduceat(steps, first), pa.float64()),
    })


def lm_score(docs: DataFrame, train: Column, mu=MU, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, train, n_tokens (words and an end), n_known (seen in training), train_tokens, base_score, score (both log10).

    Words: runs of other than ASCII white space, A-Z lower-cased; null texts count as
    empty: an end alone.  train: which documents to learn from (null: not).  Null and
    repeated doc_ids keep a row each.  Without training documents all words are unknown.
    Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    settled(spark)
    total = text_bytes(docs, text_col)
    blocks, ranges = n_blocks(spark, total, BLOCK), max(16, -(-total // RANGE_BYTES))
    marked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    dealt = spread(marked.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")), "block", blocks)

    starts = [*bucket_starts(ranges).tolist(), 1 << 64]

    def request(p: int):
        least, end = (starts[ranges * k // PASSES] for k in (p, p + 1))

        def asked(key, table: pa.Table) -> pa.Table:
            scan.trim()
            return ask(*_features(table, least, end), key[0].as_py(), ranges)

        return lambda key, table: asked(key, table)

    parts = []
    for p in range(PASSES):
        asked = dealt.groupBy("block").applyInArrow(request(p), ASKED)
        parts.append(stored(spread(asked, "bucket", ranges // PASSES).groupBy("bucket").applyInArrow(_sum_range, TOLD + ", all_words long, distinct_words long")))
    found = functools.reduce(DataFrame.union, parts)
    sums = found.groupBy("bucket").agg(F.max("all_words").alias("n"), F.max("distinct_words").alias("v")).agg(F.sum("n"), F.sum("v")).first()
    model = Model(sums[0] or 0, sums[1] or 0, marked.filter("train").count(), tuple(mu))
    told_to = spread(found.select("block", "bucket", "wide", "n", "totals"), "block", blocks)
    return dealt.groupBy("block").cogroup(told_to.groupBy("block")).applyInArrow(
        lambda left, right: _score(left, right, model),
        "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


#: The contract's rows in DuckDB SQL, over documents, with scores rounded; a blank stands for a text's end, two for its start.
SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(@LOWER@, '[^\x20\x09-\x0D]+') AS w,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 5 <> 1 AS train FROM documents
), t AS (
  SELECT doc_id, train, unnest(list_append(w, ' ')) AS x, unnest(range(0, len(w) + 1)) AS p FROM d
), g AS (
  SELECT doc_id, train, x, lag(x, 1, '  ') OVER o AS v, CASE p WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE lag(x, 2) OVER o END AS u FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), one AS (
  SELECT x, count(*) AS c FROM g WHERE train GROUP BY x
), two AS (
  SELECT v, x, count(*) AS c FROM g WHERE train GROUP BY v, x
), three AS (
  SELECT u, v, x, count(*) AS c FROM g WHERE train AND u IS NOT NULL GROUP BY u, v, x
), sums AS (
  SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS k, (SELECT count(*) FROM d WHERE train) AS starts FROM one
), steps AS (
  SELECT g.doc_id, coalesce(one.c, 0) AS c1, coalesce(two.c, 0) AS c2, coalesce(three.c, 0) AS c3, CASE WHEN g.v = '  ' THEN starts ELSE coalesce(s.c, 0) END AS s1, coalesce(b.c, 0) AS s2, (coalesce(one.c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (k + 1)) AS p1
  FROM g CROSS JOIN sums LEFT JOIN one ON one.x = g.x LEFT JOIN two ON two.v = g.v AND two.x = g.x LEFT JOIN three ON three.u = g.u AND three.v = g.v AND three.x = g.x LEFT JOIN one s ON s.x = g.v LEFT JOIN two b ON b.v = g.u AND b.x = g.v
), scores AS (
  SELECT doc_id, count(*) AS n_tokens, count(*) FILTER (c1 > 0) AS n_known, sum(log10(p1)) AS base_score, sum(log10((c3 + @M1@ * (c2 + @M0@ * p1) / (s1 + @M0@)) / (s2 + @M1@))) AS score FROM steps GROUP BY doc_id
)
SELECT doc_id, NOT train AS held_out, n_tokens, n_known, n AS train_tokens, round(base_score, 5) AS base_score, round(score, 5) AS score FROM scores JOIN d USING (doc_id) CROSS JOIN sums
""".replace("@LOWER@", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')").replace("@M0@", f"{MU[0]}::DOUBLE").replace("@M1@", f"{MU[1]}::DOUBLE")
