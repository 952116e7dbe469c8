"""Exact dedup, importance resampling and the prefix trie against brute force, with nulls, ties, repeated rows, long texts and empty tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import exact_dedup, importance, prefix_trie

FOLD = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
CLASH = "digest string, place long, bucket int, n long, keep_id long, k int, key string, codes string, score long, weight long, rank long, block int, kind string"
MORE = ("d", 1, 2, 3, 4, 5, "k", "c", 6, 7, 8, 9, "x")
TEXTS = [None, "", " ", "\t\n", "a b", "a  b", "a\n\tb", " a b", "a b ", "A b", "a b", "é" * 3, "x y " * 30_000, "x  y " * 30_000, *["same text"] * 40, "only"]


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 50, 5000):
        words = rng.integers(0, 1 << 63, (n, 4), dtype=np.uint64)
        sizes, bits = exact_dedup.perfect_hash(words)
        assert sorted(exact_dedup.slots(words, sizes, bits)) == list(range(n))
        other = exact_dedup.slots(rng.integers(0, 1 << 63, (500, 4), dtype=np.uint64), sizes, bits)
        assert (other < max(n, 1)).all()  # any slot or none: only the digest tells


@pytest.fixture(scope="module")
def docs(spark):
    ids = list(range(len(TEXTS)))
    random.Random(3).shuffle(ids)
    rows = [(i - 5, t, *MORE) for i, t in zip(ids, TEXTS, strict=True)]
    rows += [(None, "only", *MORE), (None, "no id", *MORE), (None, "no id", *MORE), (rows[4][0], "a b", *MORE), ((1 << 63) - 1, "only", *MORE), (-(1 << 63), "least", *MORE), (rows[4][0], "a b", *MORE)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASH}").repartition(3)


def test_exact_dedup(docs):
    rows = [(r.doc_id, re.sub("[ \t-\r]+", " ", r.text or "")) for r in docs.collect()]
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[t].append((i is None, i))
    expected = collections.Counter()
    for t, own in groups.items():
        own.sort(key=lambda x: (x[0], x[1] or 0))
        for k, (_, i) in enumerate(own):
            expected[i, own[0][1], len(own), k == 0, hashlib.sha256(t.encode()).hexdigest()] += 1
    got = exact_dedup.dedup_exact(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "repeats_history"]
    assert collections.Counter(tuple(r)[:5] for r in got.collect()) == expected
    assert exact_dedup.dedup_exact(docs.limit(0)).collect() == []


def test_index_serves_later_batches(spark):
    """Winners stay those of the index, whatever the ids of the batch; nonmembers are grouped among themselves."""
    make = lambda rows: exact_dedup.winners(exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")))
    history, batch = make([(10, "a"), (11, "a"), (12, "b")]), make([(1, "a"), (2, "c"), (3, "c  "), (4, "c"), (5, "b")])
    index = exact_dedup.index_of(history, 7)
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    got = {bytes(r.digest): (r.keep_id, r.group_size, r.repeats_history) for r in exact_dedup.look_up(batch, index, 7).collect()}
    assert got == {sha("a"): (10, 3, True), sha("b"): (12, 2, True), sha("c"): (2, 2, False), sha("c "): (3, 1, False)}


def plain_buckets(text, longest=1, buckets=importance.BUCKETS):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    return w, [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_buckets_of_features(longest):
    texts = [None, "", "..", "One", "one TWO two", "é1 ñ-ß " * 400, "x" * 3000 + " y", "a b c d e"]
    codes, sizes, words = importance.bucket_lists(pa.array(texts), 997, longest)
    at = 0
    for t, size, n in zip(texts, sizes, words, strict=True):
        w, own = plain_buckets(t, longest, 997)
        assert (len(w), len(own)) == (n, size) and sorted(codes[at : at + size]) == sorted(own)
        at += size


def test_resample(spark, docs):
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(["alpha", "Beta", "c1", "né", "delta"]) for _ in range(n))
    rows = [(i, say(rng.randint(15, 60))) for i in range(150)] + [(500, "word " * 25)] * 30 + [(None, say(40)), (None, say(40)), (600, None), (601, ""), (602, "one")]
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], f"doc_id long, text string, {CLASH}").repartition(4)
    target = spark.createDataFrame([(1, "alpha alpha Beta."), (2, None), (3, "")], "item_id long, text string")
    S, T = collections.Counter(), collections.Counter(b for t in ("alpha alpha Beta.",) for b in plain_buckets(t)[1])
    for _, t in rows:
        S.update(plain_buckets(t)[1])
    n = importance.BUCKETS
    gain = lambda b: math.floor(1000 * math.log((T[b] + 1) * (S.total() + n) / ((S[b] + 1) * (T.total() + n))))
    plain = []
    for i, t in rows:
        w, own = plain_buckets(t)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own))
        plain.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in plain if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for percent in (10, 37, 100, 0):
        expected = collections.Counter((*r, k + 1) for k, r in enumerate(able[: len(able) * percent // 100])) + collections.Counter((*r, None) for r in able[len(able) * percent // 100 :] + [r for r in plain if r[1] < 20])
        got = importance.resample(frame, target, percent=percent)
        assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and collections.Counter(map(tuple, got.collect())) == expected
    assert importance.resample(frame.limit(0), target).collect() == []
    assert importance.resample(frame, target.limit(0)).count() == len(rows)
    assert importance.resample(docs, target).count() == docs.count()


def test_kth_key_over_all_digits(spark):
    rng = random.Random(2)
    rows = [(rng.choice([-(1 << 40), -3, 0, 7, 1 << 50]), rng.choice([None, -9, 0, 1 << 60, 4]), p) for p in range(200)]
    frame = spark.createDataFrame(rows, "score long, doc_id long, place long")
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for k in (1, 2, 57, 120, 199, 200):
        assert importance.kth_key(frame, k) == order[k - 1]
    assert importance.kth_key(frame, 201) is None


def plain_trie(rows):
    """The nodes of rows (conv_id, turn, role, text), prefix by prefix."""
    own = collections.defaultdict(list)
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16]
    for c, n, r, t in rows:
        if c is not None:
            own[c].append((n is not None, n or 0, digest(r or "", t or ""), len(t or ""), r or "", t or ""))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    nodes = collections.defaultdict(list)
    full = {}
    for c in own:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(math.fmod(c, 100))
        full[c] = (*own.get(base, [])[:h], *own[c][h:])
        for d in range(len(full[c]) + 1):
            nodes[full[c][:d]].append(c)
    children = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(members) - 1) * (p[-1][0] if p else 0)
    sha = lambda cs: hashlib.sha256(",".join(map(str, sorted(cs))).encode()).hexdigest()
    return collections.Counter((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(c for c in m if full[c] == p)) for p, m in nodes.items())


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_trie(spark, seed, monkeypatch):
    rng = random.Random(seed)
    words = ["yes", "no", "né", "", None, "x" * 50][: rng.choice([2, 4, 6])]
    rows = []
    for c in [*range(-3, 60), *range(100, 130), 250, 399]:
        # few words, so that prefixes of all depths are shared; some conversations are all alike
        turns = [("user", "yes")] * 7 if c % 5 == 0 else [(rng.choice(["user", "assistant", None, ""]) if seed else "user", rng.choice(words)) for _ in range(rng.choice([0, 1, 2, 5, 8]))]
        rows += [(c, None if k == 1 and c % 7 == 0 else k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(7, 0, "user", "again"), (7, 0, "user", "again"), (None, 0, "user", "lost"), (900, None, None, None)]
    rows += [(1000, k, "user", "deep") for k in range(200)] + [(1001, k, "user", "deep") for k in range(190)]
    monkeypatch.setattr(prefix_trie, "EACH", (16, 1, 2, 50)[seed])
    monkeypatch.setattr(prefix_trie, "BLOB", (1 << 18, 8, 8, 1)[seed])
    frame = spark.createDataFrame([(*r, *MORE) for r in rows], f"conv_id long, turn long, role string, text string, {CLASH}").repartition(3)
    got = prefix_trie.prefix_trie(frame)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == plain_trie(rows)


def test_trie_of_one_and_of_none(spark):
    frame = spark.createDataFrame([(5, 0, "user", "hi")], "conv_id long, turn long, role string, text string")
    assert collections.Counter(map(tuple, prefix_trie.prefix_trie(frame).collect())) == plain_trie([(5, 0, "user", "hi")])
    assert prefix_trie.prefix_trie(frame.limit(0)).collect() == []
    assert prefix_trie.prefix_trie(frame.withColumn("conv_id", F.lit(None).cast("long"))).collect() == []


def test_nearest_smaller():
    rng = random.Random(4)
    for n in (0, 1, 2, 30):
        v = [rng.randint(-1, 3) for _ in range(n)]
        before, after = prefix_trie.nearest_smaller(np.array(v))
        assert list(before) == [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert list(after) == [min((j for j in range(i + 1, n) if v[j] < v[i]), default=n) for i in range(n)]
