"""Cascading deletes, merges into snapshots and broken files, against plain Python."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators import cascade
from pairloom.plans import snapshots
from pairloom.sources import quarantine

KEYS = (("edge", "a", "node"), ("edge", "b", "node"), ("map", "n", "node"), ("map", "p", "carrier"), ("note", "m", "map"))
RULES = (cascade.Rule("node", ((("edge", "a"), ("edge", "b")), (("map", "n"),))), cascade.Rule("carrier", ((("map", "p"),),)))


def _plain(tables, fixpoint):
    """The rules on sets of rows, one delete after the other."""
    t = {k: list(v) for k, v in tables.items()}

    def cascade_from():
        again = True
        while again:
            again = False
            ids = {name: {r["id"] for r in rows} for name, rows in t.items() if rows and "id" in rows[0]}
            for child, column, parent in KEYS:
                left = [r for r in t[child] if r[column] in ids.get(parent, ())]
                again |= len(left) != len(t[child])
                t[child] = left

    while True:
        before = sum(map(len, t.values()))
        for rule in RULES:
            for need in rule.needs:
                used = {r[c] for child, c in need for r in t[child]}
                t[rule.parent] = [r for r in t[rule.parent] if r["id"] in used]
            cascade_from()
        if not fixpoint or sum(map(len, t.values())) == before:
            return t


def _tables(rng):
    n = 14
    edge = [{"a": rng.randrange(n), "b": rng.randrange(n)} for _ in range(12)]
    maps = [{"id": i, "n": rng.randrange(n), "p": rng.randrange(5)} for i in range(14)]
    return {"node": [{"id": i} for i in range(n)], "carrier": [{"id": i} for i in range(5)], "edge": edge, "map": maps, "note": [{"m": rng.randrange(16), "x": i} for i in range(20)]}


@pytest.mark.parametrize("fixpoint", [False, True])
def test_prune(spark, fixpoint):
    schemas = {"node": "id long", "carrier": "id long", "edge": "a long, b long", "map": "id long, n long, p long", "note": "m long, x long"}
    for seed in range(3):
        tables = _tables(random.Random(seed))
        # every note's map exists before the first delete, as its key demands
        tables["note"] = [r for r in tables["note"] if r["m"] < 14]
        frames = {k: spark.createDataFrame([tuple(r[c.split()[0]] for c in schemas[k].split(", ")) for r in v], schemas[k]) for k, v in tables.items()}
        got = cascade.prune(frames, KEYS, RULES, fixpoint=fixpoint)
        want = _plain(tables, fixpoint)
        for name in tables:
            assert sorted(tuple(r) for r in got[name].collect()) == sorted(tuple(r.values()) for r in want[name]), (seed, name)


def test_prune_by_split_and_circles(spark):
    """Each split is pruned on its own, and a row may be in several."""
    edge = spark.createDataFrame([(1, 2, "x"), (2, 3, "x"), (1, 2, "y"), (4, 5, "y")], "a long, b long, split string")
    tables = {"node": spark.range(6), "edge": edge, "map": spark.createDataFrame([(7, 1, 1), (8, 2, 1), (9, 4, 2), (6, None, 2)], "id long, n long, p long"), "carrier": spark.range(3), "note": spark.createDataFrame([(7, 0), (9, 1), (6, 2)], "m long, x long")}
    out = cascade.prune(tables, KEYS, RULES, ("split",))
    rows = lambda name, *c: sorted(tuple(r) for r in out[name].select(*c).collect())
    assert rows("node", "split", "id") == [("x", 1), ("x", 2), ("y", 1), ("y", 2), ("y", 4)]
    assert rows("edge", "split", "a", "b") == [("x", 1, 2), ("y", 1, 2)]
    assert rows("map", "split", "id") == [("x", 7), ("x", 8), ("y", 7), ("y", 8), ("y", 9)]
    assert rows("carrier", "split", "id") == [("x", 1), ("y", 1), ("y", 2)] and rows("note", "split", "m") == [("x", 7), ("y", 7), ("y", 9)]
    with pytest.raises(ValueError):
        cascade.cascade({"p": spark.range(1), "q": spark.range(1)}, (("p", "id", "q"), ("q", "id", "p")), ["p"])


def test_merges_keep_ids_and_first_writers(spark, tmp_path):
    store = snapshots.Snapshots(spark, f"file://{tmp_path}/store")
    assert store.number() == 0 and store.read("domain") is None
    schema = "a string, b string, negative boolean, source string, p int"
    first = spark.createDataFrame([("c", "b", False, "one", 0), ("c", "b", True, "two", 1), ("b", "b", True, "two", 1)], schema)
    second = spark.createDataFrame([("c", "b", True, "late", 0), ("b", "c", True, "late", 0), ("a", "c", True, "late", 2), ("a", "c", False, "early", 1)], schema)
    assert snapshots.ingest_pairs(store, first) == 1
    ids = {r.name: r.id for r in store.read("domain").collect()}
    assert ids == {"b": 1, "c": 2}
    assert snapshots.ingest_pairs(store, second) == 2
    assert {r.name: r.id for r in store.read("domain").collect()} == ids | {"a": 3}
    assert sorted(tuple(r) for r in store.read("ddi").collect()) == [(1, 2, 1, False, "one"), (2, 1, 1, True, "two"), (3, 1, 2, True, "late"), (4, 3, 2, False, "early")]
    assert snapshots.ingest_pairs(store, second) == 3 and store.read("ddi").count() == 4  # once more changes nothing


def test_commits_that_die_or_meet(spark, tmp_path, monkeypatch):
    store = snapshots.Snapshots(spark, f"file://{tmp_path}/store")
    store.commit(t=spark.range(3), u=spark.range(1))

    class Stop(Exception):
        pass

    def stop(*_, **__):
        raise Stop

    with monkeypatch.context() as m, pytest.raises(Stop):
        m.setattr(snapshots.json, "dumps", stop)
        store.commit(t=spark.range(9))
    assert store.number() == 1 and store.read("t").count() == 3
    late, met = snapshots.Snapshots(spark, store.root), []
    number = late.number

    def meanwhile():
        now = number()
        if not met:
            met.append(store.commit(u=spark.range(5)))
        return now

    monkeypatch.setattr(late, "number", meanwhile)
    with pytest.raises(RuntimeError):
        late.commit(t=spark.range(7))
    assert store.number() == 2 and store.read("t").count() == 3 and store.read("u").count() == 5


def _lines(content):
    out = []
    try:
        for line in quarantine.lines_of(content):
            out.append(line)
    except quarantine.Broken as e:
        return out, e.reason
    return out, None


def test_lines_of_broken_files(monkeypatch):
    text = "\n".join(f"line {i} é{'x' * (i % 50)}" for i in range(3000))
    want = text.split("\n")
    zipped = gzip.compress(text.encode())
    for step in (1 << 20, 7, 1000):
        monkeypatch.setattr(quarantine, "STEP", step)
        assert _lines(text.encode()) == (want, None) and _lines(zipped) == (want, None)
        assert _lines(zipped + b"\0\0" + gzip.compress(b"\r\nlast\r\n")) == ([*want, "last"], None)
        assert _lines(b"") == ([], None) and _lines(b"a\n\nb\n") == (["a", "", "b"], None)
        got, reason = _lines(zipped[:-4])
        assert reason == "cut off" and got == want[: len(got)] and len(got) >= len(want) - 1
        got, reason = _lines(zipped[: len(zipped) // 2])
        assert reason == "cut off" and got == want[: len(got)] and 0 < len(got) < len(want)
        assert _lines(zipped + b"junk")[1] == "damaged gzip"
        got, reason = _lines(b"one\ntwo\nth\xffree\nfour")
        assert (got, reason) == (["one", "two"], "not UTF-8") and _lines("a\né".encode()[:-1]) == (["a"], "not UTF-8")


def test_quarantine(spark, tmp_path):
    good, bad = b"a\nb\n", gzip.compress(b"".join(b"row %d\n" % i for i in range(20_000)))[:-3000]
    (tmp_path / "good.txt").write_bytes(good)
    (tmp_path / "bad.gz").write_bytes(bad)
    (tmp_path / "empty.gz").write_bytes(b"")
    name = F.regexp_extract("file", "([^/]+)$", 1).alias("file")
    for keep in (False, True):
        lines, broken = quarantine.text_files(spark, f"file://{tmp_path}", keep)
        found = {r.file: r.n for r in lines.groupBy(name).agg(F.count("*").alias("n")).collect()}
        assert found.pop("good.txt") == 2 and (0 < found.pop("bad.gz", 0) < 20_000) == keep and not found
        assert [(r.file, r.reason) for r in broken.select(name, "reason").collect()] == [("bad.gz", "cut off")] and broken.first().offset == len(bad)
        assert [r.value for r in lines.filter(name == "good.txt").orderBy("line_no").collect()] == ["a", "b"]


@pytest.mark.parametrize("identity, coverage", [(1.0, 1.0), (0.4, 0.8)])
def test_similar_sequences_across_splits(spark, identity, coverage):
    """Members of all splits, pair by pair, through the aligner alone; an id in two splits is like itself."""
    import collections

    from pairloom.operators import cluster, leakage

    rng = random.Random(3)
    base = ["".join(rng.choice("ACDEFG") for _ in range(30)) for _ in range(3)]
    seqs = [(i, rng.choice([*base, base[0][:25] + "A" * 5, base[1][3:], "", None, "W" * 20])) for i in range(24)]
    placed = [(i, rng.choice("xyz")) for i in range(24)] + [(i, "x") for i in range(6)] + [(3, "x"), (99, "y")]
    text, want = dict(seqs), collections.Counter()
    members = sorted({(s, i) for i, s in placed if text.get(i)})
    for k, (s, i) in enumerate(members):
        for r, j in members[k + 1 :]:
            a, b = (text[i], text[j]) if (text[i] == text[j] or i < j) else (text[j], text[i])
            score = cluster.align(a, b)
            want[s, r] += score[0] >= identity and min(score[1:]) >= coverage
    got = leakage.similar_across(spark.createDataFrame(seqs, "id long, seq string"), spark.createDataFrame(placed, "id long, split string"), identity, coverage)
    assert {(r.split_a, r.split_b): r.pairs for r in got.collect()} == {k: n for k, n in want.items() if n}


def test_long_sequences_beside_short_ones(monkeypatch):
    from pairloom.operators import cluster

    monkeypatch.setattr(cluster, "LONGEST", 12)
    a, b = [b"ACDEFG", b"ACDEFGHIKLMNPQ", b"AC", b""], [b"ACDFG", b"ACDEFGHIKLMNP", b"ACDEFGHIKLMNPQRS", b"AC"]
    assert [tuple(x) for x in cluster.align_all(a, b).tolist()] == [cluster.align(x.decode(), y.decode()) for x, y in zip(a, b, strict=True)]


def test_tables_go_with_the_process(spark, monkeypatch):
    import os
    import urllib.parse

    from pairloom.operators import keys

    monkeypatch.setattr(keys, "_OWN", {})
    table = keys.saved(spark.range(5))
    path = urllib.parse.urlparse(table.inputFiles()[0]).path
    assert os.path.exists(path) and table.count() == 5 and len(keys._OWN) == 1
    # other tables of this session live on under another name
    files, folder = keys._OWN.popitem()[1]
    keys._OWN["one"] = (files, spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(path)))
    keys.forget()
    assert not os.path.exists(os.path.dirname(path)) and not keys._OWN
