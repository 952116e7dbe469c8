import collections
import importlib
import math

import pytest

import corpus_pipeline
from pairloom.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append({r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect())
    return out


def test_stages(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "packing"]
    before = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    langs, lines, firsts, clean, packed = stages
    assert len(langs) >= 0.99 * len(before) and all(langs[i].lang == before[i].lang for i in langs)
    texts = {(r.source, r.text) for r in langs.values()}
    pages, count = collections.Counter(source for source, _ in texts), collections.Counter()
    for source, text in texts:
        count.update({(source, x) for x in text.split("\n") if x.strip(" ")})
    for i, r in langs.items():
        kept = [x for x in r.text.split("\n") if not (x.strip(" ") and count[r.source, x] >= line_dedup.MIN_PAGES and count[r.source, x] > line_dedup.RATIO * pages[r.source])]
        assert lines[i].text == "\n".join(kept) and lines[i].n_chars == len(lines[i].text)
    sets = {}
    for i, r in lines.items():
        w = r.text.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    for i in sets:
        near = any(j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in sets)
        assert not near or i not in firsts
        assert near or i in firsts or any(j != i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in sets)
    assert set(clean) <= set(firsts)
    assert {r.doc_id for r in packed} == set(clean)
    assert len({r.sequence_id for r in packed}) <= math.ceil(sum(r.length for r in packed) / 2048) + 2


def test_null_and_repeated_ids(spark, tmp_path):
    words = lambda x, n: " ".join(f"{x}{i}" for i in range(n))
    leak = words("leak", 30)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    one, two, three = words("one", 200), words("two", 200), words("three", 200)
    near = three + " more"
    rows = [(None, one), (None, f"{words('x', 9)} {leak}"), (7, two), (7, f"{words('y', 9)} {leak}"), (None, three), (None, near), (3, near + " still"), (None, three)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)
    assert texts(corpus_pipeline.decontamination(spark, docs, str(tmp_path))) == sorted([rows[k] for k in (0, 2, 4, 5, 6, 7)], key=str)
    assert texts(corpus_pipeline.jaccard_join(spark, docs, str(tmp_path))) == sorted([rows[k] for k in (0, 1, 2, 3, 6)], key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_rows(spark, tmp_path, name):
    """Nulls in any column, empty and long texts, repeated ids and rows, columns with clashing names, and empty tables."""
    stage = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame([(1, None), (None, "x y"), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    say = " ".join(f"wort{i % 50} und" for i in range(20_000))
    rows = [(1, "the one line", "en", "s", 12), (1, "the one line", "en", "s", 12), (1, None, None, None, None), (None, None, "de", None, 0), (None, "", None, "s", 0), (2, say, "de", None, None), (2, "the one line", None, "t", 5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    more = ", tag string, block int, _key string, language string, site string, row string"
    docs = spark.createDataFrame([r + ("t", 1, "k", "l", "s", "r") for r in rows], schema + more)
    got = stage(spark, docs, str(tmp_path))
    found = got.collect()
    if name != "packing":
        assert got.columns == list(corpus_pipeline.COLUMNS)
        ours = [(r.doc_id, r.text) for r in found]
        want = {(r[0], r[1]) for r in rows}
        assert set(ours) <= want
        if name in ("line_dedup", "decontamination"):  # nothing here is boilerplate or in the benchmark
            assert sorted(ours, key=str) == sorted(((r[0], r[1]) for r in rows), key=str)
        if name == "jaccard_join":  # one row of three equal texts; blank texts stay, each once
            assert sorted(ours, key=str) == sorted([(1, "the one line"), (1, None), (None, None), (None, ""), (2, say)], key=str)
    else:
        assert len({(r.doc_id, r.ids_crc32, r.start) for r in found}) >= 5 and sum(r.piece == 0 for r in found) == len(rows)
    assert stage(spark, spark.createDataFrame([], schema), str(tmp_path)).count() == 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {"pipeline"} | {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] if x.startswith("op") else x for x in names}
    assert set(entry.oracle_sql()) <= names
