"""The registered queries on sf0.001, against plain recomputation of their contracts."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import language, lm_score, quality, queries, scan

SF = "/root/testdata/sf0.001"
FOLD = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def rest(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    rows = queries.queries()[name](spark, SF).collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op2(spark, texts):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(FOLD))
    windows = collections.defaultdict(set)
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(r.item_id)
    got = run(spark, "op2_decontamination")
    assert set(got) == set(texts)
    for i, text in texts.items():
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if own := windows.get(tuple(w[k : k + size])):
                    hit.update(range(k, k + size))
                    found |= own
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        r = got[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (len(w), len(hit), len(found), sha, bool(hit))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(found.fetchall())


def test_op5_and_op6_hold_out(spark, texts):
    got = run(spark, "op5_quality")
    assert set(got) == set(texts) and all(r.held_out == (rest(i, 4) == 2) and r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for i, r in got.items())
    tokens = {i: [*(w for w in re.split("[ \t-\r]+", t.translate(FOLD)) if w), None] for i, t in texts.items()}
    uni = collections.Counter(w for i, ws in tokens.items() if rest(i, 5) != 1 for w in ws)
    n, v = sum(uni.values()), len(uni)
    for i, r in run(spark, "op6_lm_score").items():
        base = sum(math.log10((uni[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[i])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (rest(i, 5) == 1, len(tokens[i]), sum(uni[w] > 0 for w in tokens[i]), n)
        assert r.base_score == pytest.approx(base)


def test_a_text_in_training_twice_scores_apart(spark):
    words = [f"w{k % 37}" for k in range(4000)]
    rng = np.random.default_rng(3)
    say = lambda: " ".join(rng.choice(words, 60))
    copied = say()
    rows = [(i, say()) for i in range(200)] + [(1000, copied), (1001, copied)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in lm_score.lm_score(docs, F.col("doc_id") != 1001).collect()}
    held = got[1001]
    others = lm_score.lm_score(docs, ~F.col("doc_id").isin(1000, 1001)).filter("doc_id = 1001").first()
    assert held.score > others.score + 20


def test_op10(spark, texts):
    seen, got = set(), run(spark, "op10_suffix_dedup")
    assert set(got) == set(texts)
    for i in sorted(texts):
        data, gone = texts[i].encode(), bytearray(len(texts[i].encode()))
        own = [data[k : k + 50] for k in range(len(data) - 49)]
        for k, s in enumerate(own):
            if s in seen:
                gone[k : k + 50] = b"\1" * 50
        seen.update(own)
        kept = hashlib.sha256(bytes(c for c, g in zip(data, gone, strict=True) if not g)).hexdigest()
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(data), sum(gone), spans, kept)


def test_op8_keeps_two_linked_records_a_page(spark):
    got = queries.queries()["op8_warc"](spark, SF).collect()
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert collections.Counter(r.page_id for r in got) == dict.fromkeys(pages, 2)
    for r in got:
        data = r.block.encode()
        assert r.content_length == len(data) and r.headers["WARC-Refers-To"] == r.refers_to and r.headers["WARC-Target-URI"] == pages[r.page_id].url
        assert r.headers["WARC-Payload-Digest"] == "sha1:" + __import__("base64").b32encode(hashlib.sha1((pages[r.page_id].html or "").encode()).digest()).decode()


def _plain_statistics(text):
    """quality.STATISTICS of one text, one by one."""
    data = text.encode()
    words = re.findall(rb"[^\x20\t-\r]+", data)
    lines = re.findall(rb"[^\n]+", data)
    share = lambda x, of: math.log((x + 0.05) / (max(of - x, 0) + 0.05 + 0.02 * of))
    sign = lambda b: 33 <= b < 127 and not chr(b).isalnum() and chr(b) not in ".,"
    upper = lambda x: sum(65 <= b <= 90 for b in x)
    fold = [w.lower() if w.isascii() else w.decode().translate(FOLD).encode() for w in words]
    pairs = list(zip(fold, fold[1:], strict=False)) or [tuple(fold)] * bool(fold)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / max(1, len(words))
    spread = math.sqrt(max(0.0, sum(x * x for x in lengths) / max(1, len(words)) - mean**2))
    counts = collections.Counter(data)
    return [
        math.log1p(len(words)), math.log1p(mean), math.log1p(spread), share(upper(data), len(data)), share(sum(2 * upper(w) > len(w) for w in words), len(words)),
        share(sum(48 <= b < 58 for b in data), len(data)), share(sum(map(sign, data)), len(data)), math.log1p(len({b for b in data if sign(b)})), share(sum(sign(w[-1]) for w in words), len(words)),
        share(len(set(fold)), len(words)), share(max(collections.Counter(fold).values(), default=0), len(words)), share(len(pairs) - len(set(pairs)), len(pairs)),
        share(len(lines) - len({x.decode().translate(FOLD) for x in lines}), len(lines)), math.log1p(len(words) / max(1, len(lines))), share(sum(x <= 3 for x in lengths), len(words)),
        share(sum(b >= 128 for b in data), len(data)), share(sum(b in b"!.?" for b in data), len(words)), -sum(c / len(data) * math.log2(c / len(data)) for c in counts.values()),
    ]


def test_quality_statistics(texts):
    some = ["", " \n", "one", "One TWO two\none two!\n\none TWO two\n", "a" * 300 + " " + "Ab1$ " * 50, "né É ñ, ß.\nnÉ É ñ, ß."] + [texts[i] for i in sorted(texts)[:40]]
    got = quality.statistics(*scan.text_buffer(pa.array(some)))
    assert np.allclose(got, np.array([_plain_statistics(t) for t in some]), atol=1e-9)


def test_language_posteriors(spark):
    rng = np.random.default_rng(8)
    tongue = {"aa": ["tion", "the", "ing"], "bb": ["zuß", "üch", "der"], "cc": ["der", "ing", "ko"]}
    say = lambda k, n: " ".join("".join(rng.choice(tongue[k], 2)) for _ in range(n))
    rows = [(i, say(k, int(rng.integers(1, 12))), k, [None, "aa", "cc", "xx"][i % 4], [None, "a.de", "b.de", "c.fr", "plain"][i % 5]) for i, k in enumerate(["aa", "bb", "cc"] * 30)]
    rows += [(500, "", None, None, "a.de"), (501, None, None, "bb", None), (502, "qq ww 99", None, "aa", "c.fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, declared string, host string")
    fit = docs.filter("doc_id < 60")

    def cells(text):
        letters = [b if b >= 128 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in (text or "").encode()]
        for a, b, c in zip(letters, letters[1:], letters[2:], strict=False):
            if b != 32:
                h = (a * 0x9E3779B1 & 0xFFFFFFFF) ^ (b * 0x85EBCA77 & 0xFFFFFFFF) ^ (c * 0xC2B2AE3D & 0xFFFFFFFF)
                yield (h * 0x27D4EB2F & 0xFFFFFFFF) >> 18

    langs = ["aa", "bb", "cc"]
    count = {k: collections.Counter(c for t in {r[1] for r in rows[:60] if r[2] == k} for c in cells(t)) for k in langs}
    used = len(set().union(*count.values()))

    def evidence(text, declared):
        e = []
        for k in langs:
            total = sum(count[k].values()) + language.PRIOR_COUNT * language.CELLS
            e.append(language.WEIGHT * sum(math.log((count[k][c] + language.PRIOR_COUNT) / total) for c in cells(text)))
            if declared in langs:
                e[-1] += math.log(language.DECLARED_RIGHT if declared == k else (1 - language.DECLARED_RIGHT) / 2)
        flat = language.WEIGHT * sum(-math.log(used) + language.UNKNOWN_GAIN for _ in cells(text)) + (not text)
        return [*e, flat + (math.log((1 - language.DECLARED_RIGHT) / 3) if declared in langs else 0)]

    seen = {r[0]: (evidence(r[1], r[3]), (r[4] or "")) for r in rows}
    by_host = collections.defaultdict(lambda: np.zeros(4))
    for e, host in seen.values():
        by_host[host][int(np.argmax(e))] += 1
    suffix = lambda h: h.rsplit(".", 1)[1] if "." in h else ""
    by_suffix = collections.defaultdict(lambda: np.zeros(4))
    for h, c in by_host.items():
        by_suffix[suffix(h)] += c
    root = (sum(by_host.values()) + 1) / (len(seen) + 4)
    smooth = lambda c, p: (c + language.PARENT * p) / (c.sum() + language.PARENT)
    got = {r.doc_id: r for r in language.identify(docs, fit, F.col("declared"), F.col("host")).collect()}
    assert set(got) == set(seen)
    for i, (e, host) in seen.items():
        post = np.array(e) + np.log(smooth(by_host[host], smooth(by_suffix[suffix(host)], root)))
        p = np.exp(post - post.max())
        p /= p.sum()
        k = int(p.argmax())
        assert got[i].language == [*langs, language.UNKNOWN][k] and got[i].probability == pytest.approx(p[k]) and got[i].accepted == (k < 3 and p[k] >= language.ACCEPT)
