"""Each operator against brute force on a small table with nulls, empty, long, repeated and near-equal texts."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pairloom.llm import decontaminate as op2
from pairloom.llm import fingerprints, jaccard_join, language, line_dedup, lm_score, packing, quality, scan, suffix_dedup, warc

ASCII = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, bucket string, row string, site string, host string, part int, doc long, key_a long, train string, x double, tag string, kept string, boilerplate string, ids string, item_id long"


def words(text):
    return [w for w in re.split("[ \t-\r]+", (text or "").translate(ASCII)) if w]


def make_texts():
    rng = random.Random(7)
    vocab = ["".join(rng.choice("abcdeéñß") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage, line = say(120), say(30), say(9)
    texts = [None, "", " \n\t ", "One two", "one TWO", "a", say(4), say(5), say(20_000), base, base, base.upper(), base + "\n" + line, passage]
    for _ in range(40):  # near copies, at both sides of the threshold
        w = base.split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        texts.append(" ".join(w))
    for i in range(60):
        texts.append(f"{say(rng.randint(3, 60))}\n{line}\n{passage if i % 5 == 0 else say(8)}.\n\n{say(rng.randint(1, 40))}")
    texts += ["ééé" * 40, "<|endoftext|>x don't 12,3 — İ é", "x" * 70, "y" + "x" * 70]
    return texts


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, "en" if i % 2 else "fr", f"src{i % 3}" if i % 11 else None, len(t or "")) for i, t in enumerate(make_texts())]
    return [r + (1, "b", "r", "s", "h", 2, 3, 4, "t", 0.5, "g", "k", "p", "i", 9) for r in out]


def _thue_morse(n):
    out = "a"
    while len(out) < n:
        out += out.translate(str.maketrans("ab", "ba"))
    return out


def test_word_hashes_of_words_that_agree_in_sums_of_powers():
    import pyarrow as pa

    for n in (8, 64, 1024, 4096, 1 << 16):
        one = _thue_morse(n)
        two = one.translate(str.maketrans("ab", "ba"))
        h, _ = scan.word_hashes(*scan.text_buffer(pa.array([one, two, one])), scan.NON_SPACE)
        assert h[0] == h[2] != h[1]


def test_order_of_hashes_with_equal_leading_bits():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    h[:900] = (h[0] & ~np.uint64(0xFFF)) | rng.integers(0, 4096, 900).astype(np.uint64)
    order = scan.order_of(h)
    assert (h[order] == np.sort(h)).all() and (np.diff(order)[np.diff(h[order].astype(object)) == 0] > 0).all()
    names, first, which = scan.classes(h)
    assert (names[which] == h).all() and (h[first] == names).all()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Repeated ids, repeated rows and null ids."""
    more = [(None, *rows[9][1:]), (None, None, None, None, None, *rows[0][5:]), rows[12], (12, "another text", *rows[12][2:])]
    return spark.createDataFrame(rows + more, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, odd, none, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path, with_ids=True).collect()
    by = {(r.doc_id, r.piece): r for r in got}
    for i, text, *_ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            r, part = by.pop((i, k // 2048)), np.array(ids[k : k + 2048], "<u4").tobytes()
            assert (r.start, r.length, r.ids_crc32, bytes(r.ids)) == (k, len(part) // 4, zlib.crc32(part), part)
    assert not by
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    assert packing.pack_documents(odd, path).count() == len(got) + 4
    assert packing.pack_documents(none, path).count() == 0


def test_byte_pair_merges():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = packing.WordEncoder(path)
    rng = random.Random(1)
    texts = ["".join(rng.choice("aaabß'stTÉ×.,!0 9\n—́") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    import pyarrow as pa

    ids, begins = encoder.encode(*scan.text_buffer(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids, t


def _alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII))


@pytest.fixture(scope="module")
def items(spark, rows):
    own = [(1, rows[13][1]), (2, " ".join(rows[70][1].split()[2:14])), (10, "ONE, two"), (3, None), (4, " .,"), (None, "one two"), (5, rows[13][1]), (1, rows[13][1])]
    return spark.createDataFrame(own, "item_id long, text string")


@pytest.mark.parametrize(("portion", "candidates"), [(200_000, 1 << 19), (25, 7)])
def test_decontamination(docs, odd, none, items, rows, portion, candidates, monkeypatch):
    monkeypatch.setattr(op2, "QUERY_PAIRS", portion)
    monkeypatch.setattr(op2, "CANDIDATES", candidates)
    windows = collections.defaultdict(set)
    for r in items.collect():
        w = _alnum(r.text)
        if w and r.item_id is not None:
            for k in range(max(1, len(w) - 9)):
                windows[tuple(w[k : k + 10])].add(r.item_id)
    got = {r.doc_id: r for r in op2.decontaminate(docs, items).collect()}
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        w, hit, found = _alnum(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) == (len(w), len(hit), len(found), sorted(map(str, found)), bool(hit))
    assert op2.decontaminate(odd, items).count() == len(rows) + 4
    assert op2.decontaminate(none, items).count() == 0
    assert op2.decontaminate(docs, items.limit(0)).filter("contaminated").count() == 0


def test_near_search(spark):
    docs = spark.createDataFrame([(1, "a x b y c"), (2, "a x x x x b c"), (3, "c b a"), (4, "a b"), (5, "c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    near = op2.matches(op2.build_index(docs), items, slop=2)
    assert {r.doc_id for r in near.collect() if r.hits} == {1, 3}
    exact = op2.matches(op2.build_index(docs), items)
    assert not [r for r in exact.collect() if r.hits]
    assert {r.doc_id: r.n_near for r in op2.proximity(docs, items, slop=2).collect()} == {1: 1, 2: 0, 3: 1, 4: 0, 5: 0}
    found = op2.matches(op2.build_index(docs), spark.createDataFrame([(7, "x b"), (8, "x B,"), (9, "a")], "item_id long, text string"))
    assert {r.doc_id: sorted(map(tuple, r.hits)) for r in found.collect()} == {1: [(7, 1, 2), (8, 1, 2), (9, 0, 1)], 2: [(7, 4, 2), (8, 4, 2), (9, 0, 1)], 3: [(9, 2, 1)], 4: [(9, 0, 1)], 5: []}


@pytest.mark.parametrize(("portion", "candidates"), [(200_000, 1 << 19), (5, 30)])
def test_proximity(spark, portion, candidates, monkeypatch):
    monkeypatch.setattr(op2, "QUERY_PAIRS", portion)
    monkeypatch.setattr(op2, "CANDIDATES", candidates)
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 40))) for _ in range(120)]
    own = [(i, " ".join(rng.choice("abcdefghi") for _ in range(rng.randint(1, 6)))) for i in range(25)]
    got = {r.doc_id: r.near for r in op2.proximity(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(own, "item_id long, text string"), window=4, slop=2).collect()}
    for i, text in enumerate(texts):
        w, near = text.split(), set()
        for item, t in own:
            words_ = t.split()
            for k in range(max(1, len(words_) - 3)):
                window = words_[k : k + 4]
                if any(set(window) <= set(w[a : a + len(window) + 2]) for a in range(len(w))):
                    near.add(str(item))
        assert got[i] == sorted(near)


def test_windows_of_frequent_words_take_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    text = "a b " * 100_000
    index = op2.Postings(op2._post((pa.scalar(0),), pa.table({"doc_id": [1], "text": [text]})), 0)
    window = scan.word_hashes(*scan.text_buffer(pa.array(["a b " * 5])), scan.ALNUM)[0].tobytes()
    peaks = []
    for n in (20, 80):
        tracemalloc.start()
        query = op2.Query([window] * n, list(range(n)), 10)
        assert sum(len(w) for w, _ in op2.search(index, query)) == 100_000 - 4 and sum(len(w) for w, _ in op2.search(index, query, 5)) == 100_000
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert max(peaks) < 100 << 20 and peaks[1] < 1.2 * peaks[0]


def test_fingerprints(docs, odd, none, rows, spark):
    import base64

    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}

    def parsed(fp):
        digits = base64.b64decode(fp).hex()
        return [(int(digits[k], 16), int(digits[k + 1 : k + 9], 16)) for k in range(0, len(digits) - 8, 9)]

    of = lambda fp: {h for _, h in parsed(fp)}
    for k, (i, text, *_) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, r, there = of(got[i].fingerprint), got[i], of(got[i].edited_fingerprint)
        other = of(got[rows[(k + 1) % len(rows)][0]].fingerprint)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.near_next == pytest.approx(len(own & other) / len(own | other) if own | other else 1.0)
        assert r.near_edited == pytest.approx(len(own & there) / len(own | there) if own | there else 1.0)
    assert got[9].fingerprint == got[10].fingerprint and got[0].fingerprint == "" and got[3].fingerprint
    # the choice of anchors of all texts, by brute force
    K, S, inner = fingerprints.K, fingerprints.S, fingerprints.K - fingerprints.S
    blank = [[w for w in re.split("[ \t-\r]+", t or "") if w] for _, t, *_ in rows]
    hashed = lambda pieces: dict(zip(pieces, (r.h for r in spark.createDataFrame([(list(p),) for p in pieces], "p array<bigint>").select(F.xxhash64(*[F.get("p", F.lit(d)) for d in range(len(pieces[0]))]).alias("h")).collect()), strict=True))
    of_word = dict(zip(vocabulary := sorted({w for ws in blank for w in ws}), (r.h for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select(F.xxhash64("w").alias("h")).collect()), strict=True))
    sequences = [[of_word[w] for w in ws] for ws in blank]
    runs = lambda h, n: [tuple(h[k : k + n]) for k in range(len(h) - n + 1)]
    small, large = (hashed(sorted({p for h in sequences for p in runs(h, n)})) for n in (S, K))
    for (i, *_), h in zip(rows, sequences, strict=True):
        g = [small[p] for p in runs(h, S)]
        want = [(k, large[tuple(h[k : k + K])] & 0xFFFFFFFF) for k in range(len(h) - K + 1) if min(g[k : k + inner + 1]) in (g[k], g[k + inner])]
        assert not want or max(b - a for (a, _), (b, _) in zip([(-1, 0), *want], want, strict=False)) <= inner + 1
        steps = [(b - a, x) for (a, _), (b, x) in zip([(0, 0), *want], want, strict=False)]
        assert parsed(got[i].fingerprint) == steps if want else len(parsed(got[i].fingerprint)) == bool(h)
        assert got[i].words_kept <= max(len(h), K)
    shown = spark.createDataFrame([(got[8].fingerprint,), ("",)], "f string").select(fingerprints.read_string(F.col("f")).alias("a")).collect()
    assert [tuple(a) for a in shown[0].a] == parsed(got[8].fingerprint) and shown[1].a == []
    assert sum(len(r.fingerprint) for r in got.values()) < 0.4 * sum(len((t or "").encode()) for _, t, *_ in rows)
    # half of a long text stays as it was, and the anchors say so
    r = got[8]
    kept = len(rows[8][1][: r.n_chars - r.n_chars // 2].split())
    assert kept - 2 * K <= r.words_kept <= kept
    assert fingerprints.fingerprint_edits(odd).count() == len(rows) + 4
    assert fingerprints.fingerprint_edits(none).count() == 0


@pytest.mark.parametrize("limit", [8 << 20, -1])
def test_line_dedup(docs, odd, none, rows, limit, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", limit)
    pages, count = collections.Counter(), collections.Counter()
    for source, text in {(source, text or "") for _, text, _, source, *_ in rows}:
        pages[source] += 1
        count.update({(source, x) for x in text.split("\n") if x.strip(" ")})
    drop = {k for k, n in count.items() if n >= line_dedup.MIN_PAGES and n > pages[k[0]] * line_dedup.RATIO}
    assert drop
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    for i, text, _, source, *_ in rows:
        r = got[i]
        lines = text.split("\n") if text else []
        kept = [x for x in lines if (source, x) not in drop]
        assert (r.n_lines, r.n_dropped, r.text) == (len(lines), len(lines) - len(kept), text if not text else "\n".join(kept))
        assert (r.boilerplate, r.site, r.kept) == ("p", "s", "k")
    assert line_dedup.dedup_lines(odd).count() == len(rows) + 4
    assert line_dedup.dedup_lines(none).count() == 0


def test_copies_do_not_make_their_lines_boilerplate(spark):
    copies = [(i, "one\ntwo\nmenu", "s") for i in range(30)]
    others = [(100 + i, f"page {i}\nmenu", "s") for i in range(20)]
    docs = spark.createDataFrame(copies + others, "doc_id long, text string, source string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert set(got[i] for i in range(30)) == {"one\ntwo"} and all(got[100 + i] == f"page {i}" for i in range(20))


def test_quality(spark, none):
    rng = random.Random(3)
    good = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(20, 200)))
    bad = lambda: " ".join(rng.choice(["BUY!!", "now$$$", "win***"]) for _ in range(rng.randint(20, 200)))
    rows = [(i, good() if i % 2 else bad()) for i in range(300)] + [(1000, None), (1001, ""), (1002, None), (None, good()), (5, good())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(1000, 1), (7, None), (None, 1), (8, 3)], "doc_id long, label int")
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert sum(r.predicted == r.doc_id % 2 for r in held) >= 98
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    assert quality.score_quality(none.select("doc_id", "text"), labels).count() == 0
    assert quality.score_quality(docs, labels.limit(0)).select("score").distinct().count() == 1


def test_discriminant_is_gaussian():
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (300, 3))
    model = quality.Discriminant([400, 300], np.stack([a.sum(0), b.sum(0)]), np.stack([a.T @ a, b.T @ b]), shrink=0, ridge=0)
    x = rng.normal(0.5, 1, (50, 3))

    def log_density(x, own):
        cov, mean = np.cov(own.T, bias=True), own.mean(axis=0)
        d = x - mean
        return -0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])

    odds = log_density(x, b) + math.log(301 / 702) - log_density(x, a) - math.log(401 / 702)
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-odds)))


def test_lm_score(docs, odd, none, rows):
    train = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    mark = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    tokens = {i: [*words(t), None] for i, t, *_ in rows}
    uni, pairs, triples, starts = collections.Counter(), collections.Counter(), collections.Counter(), 0
    for i, w in tokens.items():
        if train(i):
            uni.update(w)
            pairs.update(zip(["<s>", *w[:-1]], w, strict=True))
            triples.update(zip(["<s>", *w[:-2]], w, w[1:], strict=False))
            starts += 1
    n, v = sum(uni.values()), len(uni)
    context = dict(uni) | {"<s>": starts}
    m, k = lm_score.MU
    for r in lm_score.lm_score(docs, mark).collect():
        w = tokens[r.doc_id]
        p = [(uni[x] + 0.5) / (n + 0.5 * (v + 1)) for x in w]
        score = 0.0
        for at, (a, b) in enumerate(zip(["<s>", *w[:-1]], w, strict=True)):
            # from the state of the longest context, over failure arcs, to one that goes on with the word
            before = ["<s>", *w][at - 1] if at else None
            root = math.log10(p[at])
            arc = math.log10((pairs[a, b] + m * p[at]) / (context.get(a, 0) + m))
            step = arc if pairs[a, b] else math.log10(m / (context.get(a, 0) + m)) + root
            if at and pairs[before, a]:
                step = math.log10((triples[before, a, b] + k * 10**arc) / (pairs[before, a] + k)) if triples[before, a, b] else math.log10(k / (pairs[before, a] + k)) + step
            score += step
        assert (r.train, r.n_tokens, r.n_known, r.train_tokens) == (train(r.doc_id), len(w), sum(uni[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(map(math.log10, p))) and r.score == pytest.approx(score)
    assert lm_score.lm_score(odd, mark).count() == len(rows) + 4
    assert lm_score.lm_score(none, mark).count() == 0
    alone = lm_score.lm_score(docs, F.lit(False)).filter("n_known > 0 or train_tokens > 0")
    assert alone.count() == 0


def _automaton(texts, train, mu=(3.0, 2.0)):
    """An automaton of small numbers, with the n-grams of its arcs by hand."""
    flat = [w for t in texts for w in [*t, "</s>"]]
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    grams = [[], [], []]
    for t in texts:
        w = ["<s>", *t, "</s>"]
        grams[0] += [(x,) for x in w[1:]]
        grams[1] += list(zip(w, w[1:], strict=False))
        grams[2] += [None, *zip(w, w[1:], w[2:], strict=False)]
    count = collections.Counter()
    for t in train:
        w = ["<s>", *t, "</s>"]
        count.update([(x,) for x in w[1:]])
        count.update(zip(w, w[1:], strict=False))
        count.update(zip(w, w[1:], w[2:], strict=False))
    numbers = [{g: k for k, g in enumerate(dict.fromkeys(x for x in own if x))} for own in grams]
    ids = [np.array([-1 if g is None else number[g] for g in own]) for own, number in zip(grams, numbers, strict=True)]
    counts = [np.array([0 if g is None else count[g] for g in own]) for own in grams]
    n = sum(c for g, c in count.items() if len(g) == 1)
    model = lm_score.Model(n, sum(len(g) == 1 for g in count), len(train), mu)
    return lm_score.Automaton.of(model, ids, counts, begins[:-1]), begins, flat


def test_walks_over_states_and_failure_arcs(monkeypatch):
    train = [["a", "b", "c"], ["a", "b", "d"], ["b", "c"], ["a"]]
    texts = [["a", "b", "c", "z", "a", "b"], ["b", "d"], [], ["z", "z"]]
    machine, begins, _ = _automaton(texts, train)
    whole = machine.walk(begins)
    for segment in (1, 2, 3):  # any cut of the texts walks alike
        monkeypatch.setattr(lm_score, "SEGMENT", segment)
        assert np.allclose(machine.walk(begins), whole)
    monkeypatch.setattr(lm_score, "SEGMENT", 512)
    # without the arc of (a, b, c), the walk fails to (b) and goes on from there
    at = 2
    arc = machine.leads[0][at]
    pair = machine.source[arc]
    assert machine.depth[pair] == 2 and whole[at] == machine.weight[arc]
    machine.source[arc] = -1
    shorter = machine.leads[1][at]
    assert machine.source[shorter] == machine.failure[pair] and np.isclose(machine.walk(begins)[at], machine.failure_weight[pair] + machine.weight[shorter])
    machine.source[shorter] = -1
    word = machine.failure[pair]
    assert machine.failure[word] == 0 and np.isclose(machine.walk(begins)[at], machine.failure_weight[pair] + machine.failure_weight[word] + machine.weight[machine.leads[2][at]])
    # an unknown word leads to the root, from which no failure arc is taken
    assert machine.below[4] == 0 and whole[4] == machine.weight[machine.leads[2][4]]


def test_language(spark, odd, none):
    rng = random.Random(5)
    tongue = {"aa": ["tion", "the", "ing", "and"], "bb": ["zuß", "üch", "keit", "der"]}
    say = lambda k: " ".join("".join(rng.choice(tongue[k]) for _ in range(rng.randint(1, 3))) for _ in range(30))
    rows = [(i, say("aa" if i % 2 else "bb"), "aa" if i % 2 else "bb", "www.x.de" if i % 2 else None) for i in range(120)]
    rows += [(200, None, None, None), (201, "", None, None), (202, "0123 4567 !!!! $$$$ " * 9, None, None), (203, "qxqjv wqkzx xjqvw " * 20, None, "www.x.de"), (204, say("aa"), "bb", "www.x.de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    fit = docs.filter("doc_id < 80")
    got = {r.doc_id: r for r in language.identify(docs, fit, F.col("lang"), F.col("host")).collect()}
    assert len(got) == len(rows)
    assert all(got[i].language == ("aa" if i % 2 else "bb") and got[i].accepted for i in range(120))
    assert got[204].language == "aa" and got[203].language == "und" and not got[203].accepted
    assert all(0 < r.probability <= 1 for r in got.values())
    assert language.identify(odd, odd, F.col("lang"), F.col("source")).count() == odd.count()
    assert language.identify(none, none, F.col("lang"), F.col("source")).count() == 0
    assert {r.language for r in language.identify(docs, fit.limit(0), F.col("lang"), F.col("host")).collect()} == {"und"}


def test_declared_language(spark):
    pages = spark.createDataFrame([('<!doctype html><html lang="de-AT"><head>',), ("<html><p lang=fr>",), (None,), ("<HTML class=x LANG='FR'>",)], "html string")
    assert [r[0] for r in pages.select(language.declared_in(F.col("html"))).collect()] == ["de", None, None, "fr"]


def test_warc(spark):
    html = '<html lang="en"><head><title>A &amp; B</title><meta name="k" content="v"></head><body><script>x()</script><p>One <b>two</b></p><a href="/x?a=1&amp;b=2">link</a><!-- no --></body></html>'
    pages = spark.createDataFrame([(1, "http://h.example/", html, "x"), (2, None, None, "x"), (3, "http://h.example/", html, "x"), (None, "u", "", "x"), (4, "u", "<", "x")], "page_id long, url string, html string, headers string")
    got = warc.build_derivatives(pages).collect()
    assert len(got) == 10
    own = {r.record_type: r for r in got if r.page_id == 1}
    assert own["conversion"].block == "One two\nlink"
    assert own["metadata"].refers_to == own["conversion"].refers_to == own["conversion"].headers["WARC-Refers-To"]
    assert own["metadata"].refers_to == warc.response_id("http://h.example/", html.encode())
    meta = __import__("json").loads(own["metadata"].block)["Envelope"]["Payload-Metadata"]["HTTP-Response-Metadata"]
    assert meta["HTML-Metadata"]["title"] == "A & B" and {"path": "a", "url": "/x?a=1&b=2"} in meta["HTML-Metadata"]["links"]
    data = b"".join(warc.write_record(dict(r.headers), r.block.encode(), "2020-01-01T00:00:00Z") for r in got)
    back = list(warc.read_records(data))
    assert [(h["WARC-Record-ID"], b.decode()) for h, b in back] == [(r.record_id, r.block) for r in got]
    for h, b in back:
        assert h["WARC-Block-Digest"] == warc.digest(b) and int(h["Content-Length"]) == len(b)
    assert warc.build_derivatives(pages.limit(0)).count() == 0


def test_warc_reader_and_files(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type:text/html\r\nX-A: b\r\n\r\n<p>Hi</p>"
    plain = b"WARC/1.1\r\nWARC-Type:response\r\nWARC-Record-ID:<urn:x:1>\r\nWARC-Target-URI: http://h/\r\nX-Long: a\r\n  b\r\ncontent-length:%d\r\n\r\n%s\r\n\r\n" % (len(http), http)
    (headers, block), = warc.read_records(plain)
    assert (headers["WARC-Type"], headers["X-Long"], block) == ("response", "a b", http)
    assert list(warc.read_records(plain + plain[:-20])) == [(headers, block)] and list(warc.read_records(b"")) == []
    members = [warc.write_record({"WARC-Type": "resource", "Content-Length": str(n)}, b"\r\n" * (n // 2), "d") for n in (0, 2, 3 << 20)]
    assert [len(b) for _, b in warc.read_records(b"".join(members))] == [0, 2, 3 << 20]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(plain)
    responses = warc.read_responses(spark, str(tmp_path / "in"))
    got = warc.build_derivatives(responses, headers_col="headers", record_col="record_id").collect()
    assert {r.refers_to for r in got} == {"<urn:x:1>"} and {r.headers["X-Source-X-A"] for r in got} == {"b"} and got[1].block == "Hi"
    files = warc.write_files(warc.build_derivatives(responses), str(tmp_path / "out"), "2020-01-01T00:00:00Z", each=1).collect()
    assert sorted((h["WARC-Type"], b.decode()) for f in files for h, b in warc.read_records(f.data))[0] == ("conversion", "Hi")


def test_largest_and_null_ids_of_documents(spark, monkeypatch):
    """2^63 - 1 is an id as any other; several portions whose spans overlap count a word once."""
    top = (1 << 63) - 1
    docs = spark.createDataFrame([(top, "a b c d e"), (5, "a b"), (None, "b c d"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c"), (2, "b c d"), (3, "c"), (4, "c d e"), (5, "e")], "item_id long, text string")
    for portion in (200_000, 1, 2):
        monkeypatch.setattr(op2, "QUERY_PAIRS", portion)
        got = sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in op2.decontaminate(docs, items).collect()), key=str)
        assert got == sorted([(top, 5, 5, ["1", "2", "3", "4", "5"]), (5, 2, 0, []), (None, 3, 3, ["2", "3"]), (None, 0, 0, [])], key=str)


def test_damaged_warc_files():
    """What is damaged is left out and counted; all records around it are read."""
    record = lambda n, size=None, end=b"\r\n\r\n": b"WARC/1.1\r\nWARC-Type: resource\r\nX-N: %d\r\nContent-Length: %s\r\n\r\n%s" % (n, size or b"4", b"b%03d" % n) + end
    zipped = lambda data: __import__("gzip").compress(data)

    def read(data):
        counted = collections.Counter()
        return [int(h["X-N"]) for h, b in warc.read_records(data, counted)], dict(counted)

    for bad in (b"x", b"-2", b"", b"1e3", "٤".encode()):
        assert read(record(1) + record(2, bad or b" ") + record(3)) == ([1, 3], {"no length": 1})
        assert read(zipped(record(1)) + zipped(record(2, bad or b" ")) + zipped(record(3))) == ([1, 3], {"no length": 1})
    assert read(b"junk\r\n" + record(1) + b"more junk\r\n" + record(2)) == ([1, 2], {"no record": 2})
    assert read(record(1) + record(2)[:-10]) == ([1], {"cut off": 1}) and read(record(1) + b"WA") == ([1], {"no record": 1})
    one, two, three = (zipped(record(k)) for k in (1, 2, 3))
    assert read(one + b"\0" * 7 + two) == ([1, 2], {})
    assert read(one + b"junk" * 40 + two + b"tail") == ([1, 2], {"bytes between members": 2})
    assert read(one + two[:-12] + three)[0] in ([1, 3], [1, 2, 3]) and read(one + two[: len(two) // 2])[0] == [1]
    broken = two[:14] + bytes(255 - b for b in two[14:20]) + two[20:]
    got, counted = read(one + broken + three)
    assert got[0] == 1 and got[-1] == 3 and sum(counted.values()) >= 1
    long = b"WARC/1.1\r\nX-N: 7\r\nContent-Length: %d\r\n\r\n" % (3 << 20) + b"\0" * (3 << 20) + b"\r\n\r\n"
    assert read(zipped(long[: 1 << 20])[:-8] + zipped(long) + three)[0] == [7, 3]


def test_responses_and_what_was_left_out(spark):
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>"), (2, None, None), (3, "http://b/é", "é" * 5)], "page_id long, url string, html string")
    records = warc.response_records(pages, F.concat(F.lit("<urn:p:"), "page_id", F.lit(">"))).collect()
    data = [warc.write_record(dict(r.headers), r.block.encode(), "d") for r in records]
    bad = b"WARC/1.1\r\nContent-Length: x\r\n\r\n"
    files = spark.createDataFrame([("good", b"".join(data)), ("bad", data[0] + bad + data[1]), ("none", None)], "path string, content binary")
    got = warc.responses_of(files).collect()
    assert sorted((r.record_id, r.url, r.html) for r in got) == sorted([("<urn:p:1>", "http://a/", "<p>x</p>")] * 2 + [("<urn:p:2>", "", "")] * 2 + [("<urn:p:3>", "http://b/é", "é" * 5)])
    assert all(r.headers == dict(warc.SOURCE_HEADERS) for r in got)
    assert [tuple(r) for r in warc.skipped_in(files).collect()] == [("bad", "bytes between members", 1)]


class _Reader(__import__("html.parser").parser.HTMLParser):
    """Text outside of head and raw elements, links and metas, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.words, self.links, self.metas, self.raw, self.head = [], [], [], None, False

    def handle_starttag(self, tag, attrs):
        if self.raw:
            return
        if tag == "meta":
            self.metas.append(sorted((k, v) for k, v in attrs if v))
        if url := dict(reversed(attrs)).get(warc._LINKS.get(tag)):
            self.links.append((tag, url))
        self.raw = tag if tag in warc._RAW else None
        self.head = tag == "head" or self.head and tag != "body"
        if tag in warc._BREAKS:
            self.words.append(" ")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == self.raw:
            self.raw = None
            self.words.append(" ")
        elif not self.raw and tag == "head":
            self.head = False
        if not self.raw and tag in warc._BREAKS:
            self.words.append(" ")

    def handle_data(self, data):
        if not self.raw and not self.head:
            self.words.append(data)

    def handle_comment(self, data):
        self.words.append(" ")

    def handle_entityref(self, name):
        self.handle_data(__import__("html").unescape(f"&{name};"))

    def handle_charref(self, name):
        self.handle_data(__import__("html").unescape(f"&#{name};"))


def test_pages_against_the_standard_parser(spark):
    """All pages, and tags with signs in quotes, have the words, links and metas that html.parser finds."""
    import html as entities

    pages = [r.html or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    pages += ['<p title="a > b">x</p><img alt="1>2" src="u">', "<a href='x>y'>z</a><a title=it's href=q>w</a>", '<p a="<b>" b=\'"\'>t</p >u', '<meta name="a>b" content=\'c"d\'><body>k', '<p title="never closed>x</p>y']
    for page in pages:
        reader = _Reader()
        reader.feed(page)
        text, found = warc.read_page(page)
        if "never closed" not in page:
            assert text.split() == "".join(reader.words).split(), page
            assert [(x["path"], x["url"]) for x in found["links"]] == [(t, u) for t, u in reader.links], page
            assert [sorted((k, entities.unescape(v)) for k, v in m.items() if v) for m in found["metas"]] == reader.metas, page
    assert warc.plain_text(pages[-1]) == "x\ny"


def test_malformed_pages_take_linear_time():
    import time

    for part in ("<script>", "<a ", "<!--", '<a href="', "<head>", "a=' "):
        took = []
        for n in (8000, 64000):
            began = time.process_time()
            warc.read_page(part * n)
            warc.read_page("<a " + part * n + ">")
            took.append(time.process_time() - began)
        assert took[1] < 24 * took[0] + 0.5, part
    assert warc.plain_text("a < b <b>c</b> 1<2 <x") == "a < b c 1<2 <x"
    assert warc.plain_text("<head>x<body>y<p>z<script>") == "y\nz"


@pytest.mark.parametrize(("tile", "columns"), [(512, 2048), (4, 16)])
def test_jaccard_join(docs, odd, none, rows, tile, columns, monkeypatch):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "COLUMNS", columns)
    sets = {}
    for i, text, *_ in rows:
        w = words(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    comp = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(links) > 100
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            changed |= comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
    got = {r.doc_id: r for r in jaccard_join.jaccard_components(docs).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == {i: (len(sets[i]), comp[i]) for i in sets}
    if tile == 512:
        own = [(1, rows[9][1]), (6, rows[9][1]), (6, rows[8][1]), (100, rows[8][1]), (None, rows[13][1] + " x"), (None, rows[6][1]), (50, rows[13][1]), (51, rows[6][1]), (6, None)]
        tied = jaccard_join.jaccard_components(docs.sparkSession.createDataFrame(own, "doc_id long, text string")).collect()
        assert sorted((r.doc_id, r.component_id) for r in tied if r.doc_id is not None and r.n_shingles) == [(1, 1), (6, 1), (6, 1), (50, 50), (51, 51), (100, 1)]
        assert all(r.component_id is None for r in tied if r.doc_id is None)
        more = jaccard_join.jaccard_components(odd).collect()
        assert len(more) == len(rows) + 4 and sum(r.doc_id is None for r in more) == 2
        assert jaccard_join.jaccard_components(none).count() == 0


def test_suffix_dedup(docs, odd, none, rows):
    seen, got = set(), {r.doc_id: r for r in suffix_dedup.remove_repeats(docs).collect()}
    removed = 0
    for i, text, *_ in rows:
        data = (text or "").encode()
        own = [data[k : k + 50] for k in range(len(data) - 49)]
        gone = bytearray(len(data))
        for k, s in enumerate(own):
            if s in seen:
                gone[k : k + 50] = b"\1" * 50
        seen.update(own)
        r = got[i]
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        assert (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) == (len(data), sum(gone), spans, kept), i
        removed += sum(gone)
    assert removed > 1000
    assert suffix_dedup.remove_repeats(odd).count() == len(rows) + 4
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize(("n", "depth", "values"), [(0, 3, 3), (1, 2, 3), (500, 6, 3), (3000, 2, 1 << 60), (2000, 11, 2)])
def test_multikey_sort(n, depth, values):
    rng = np.random.default_rng(1)
    words_ = rng.integers(0, values, (n, depth)).astype(np.uint64)
    order = suffix_dedup.multikey_sort(words_)
    listed = [tuple(x) for x in words_[order].tolist()]
    assert sorted(order.tolist()) == list(range(n)) and listed == sorted(listed)


def test_suffix_runs_across_boundaries(spark, monkeypatch):
    """A frequent passage with many continuations, dealt to so many buckets that its runs cross them."""
    monkeypatch.setattr(suffix_dedup, "BUCKETS", 300)
    rng = random.Random(9)
    say = lambda n: "".join(rng.choice("ab cd") for _ in range(n))
    hot = say(60)
    rows = [(i, f"{say(rng.randint(0, 60))}{hot[: rng.randint(20, 60)]}{say(rng.randint(0, 60))}{'xy' * rng.randint(0, 60)}") for i in range(150)]
    seen, got = set(), {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        data, gone = text.encode(), bytearray(len(text))
        own = [data[k : k + 50] for k in range(len(data) - 49)]
        for k, s in enumerate(own):
            if s in seen:
                gone[k : k + 50] = b"\1" * 50
        seen.update(own)
        assert (got[i].n_removed, bytes(got[i].kept)) == (sum(gone), bytes(c for c, g in zip(data, gone, strict=True) if not g)), i


def test_components(spark):
    from pairloom.llm.components import connected_components

    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (100, 100), (None, 3), (300, 200), (200, 250), (250, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 200: 200, 250: 200, 300: 200}


def test_language_of_mislabelled_documents_and_of_pages(spark, tmp_path):
    from pairloom.llm import queries

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = sorted(r.doc_id for r in docs.filter("n_chars between 40 and 120").collect())[:4]
    other = F.when(F.col("lang") == "en", "de").otherwise("en")
    docs.withColumn("lang", F.when(F.col("doc_id").isin(short), other).otherwise(F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet("/root/testdata/sf0.001/pages.parquet").write.parquet(f"{tmp_path}/pages.parquet")
    wrong = {r.doc_id: r.lang for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect() if r.doc_id in short}
    found = {r.doc_id: r.language for r in queries.op7_language(spark, str(tmp_path)).collect()}
    assert short and not [i for i in short if found[i] == wrong[i]]
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{tmp_path}/pages.parquet").collect()}
    got = queries.queries()["op7_language_pages"](spark, str(tmp_path)).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    assert sum(f'lang="{r.language}"' in pages[r.page_id] for r in got) >= 0.9 * len(pages)
