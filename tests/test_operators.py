import collections
import hashlib
import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.config import Config
from pairloom.operators import cluster, embed, graph, keys, matched, negatives, partition, product, split, stats
from pairloom.schema import empty_database, require_unique
from pairloom.sources import dump, readers, sinks, staging

EDGES = [(1, 1, 2, False), (2, 1, 3, False), (3, 2, 3, False), (4, 1, 1, False), (5, 4, 5, True), (6, 1, 4, True), (7, 5, 6, True)]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "id long, a long, b long, negative boolean")


def test_bias(spark, edges):
    deg = graph.degrees(edges)
    assert {(r.node, r.pos, r.neg) for r in deg.collect()} == {(1, 4, 1), (2, 2, 0), (3, 2, 0), (4, 0, 2), (5, 0, 2), (6, 0, 1)}
    names = spark.createDataFrame([(1, "PF00001")], "id long, pfam_id string")
    r = stats.bias_report(edges, names).first()
    assert (r.pos_mean, r.pos_median, r.neg_mean, r.neg_median) == (pytest.approx(8 / 3), 2.0, 1.5, 1.5)
    assert r.ks_statistic == pytest.approx(0.5) and r.ks_p_value == pytest.approx(0.6159658, abs=1e-6)
    assert r.gini == pytest.approx(0.2380952, abs=1e-6) and r.warning and (r.n_pure_positive, r.n_pure_negative) == (2, 3)
    assert (r.n_positive, r.n_negative) == (4, 3) and r.ratio == pytest.approx(4 / 3)
    assert r.top[0].pfam_id == "PF00001" and r.top[1].pfam_id == "?"
    assert "gini" in sinks.bias_text(stats.bias_report(edges, names))


def test_prune(spark, edges):
    mapped = spark.createDataFrame([(1, 10), (2, 10), (3, 11), (4, 12), (6, 13)], "domain long, protein long")
    keep = edges.select("id", F.lit("all").alias("split")).union(edges.filter("id in (3, 5, 7)").select("id", F.lit("odd").alias("split")))
    out = split.materialize(edges, mapped, keep)
    get = lambda name, col, s: {r[col] for r in out[name].filter(F.col("split") == s).collect()}
    assert get("domains", "domain", "all") == {1, 2, 3, 4, 6} and get("edges", "id", "all") == {1, 2, 3, 4, 6} and get("proteins", "protein", "all") == {10, 11, 12, 13}
    assert get("domains", "domain", "odd") == {2, 3, 4, 6} and get("edges", "id", "odd") == {3}


def test_keys(spark):
    rows = spark.createDataFrame([("P", "Q", 0, "A"), ("P", "Q", 1, "B"), ("Q", "P", 1, "B"), ("R", "S", 1, "B"), ("R", "S", 1, "B")], "a string, b string, p int, source string")
    first = keys.surrogate_ids(keys.keep_first(rows, ["a", "b"], "p"), "p", "a")
    assert [tuple(r) for r in first.orderBy("id").collect()] == [("P", "Q", 0, "A", 1), ("Q", "P", 1, "B", 2), ("R", "S", 1, "B", 3)]
    for n, want in ((3, [0, 1, 2]), (7, [0, 0, 1, 1, 2, 2, 3]), (10, [0, 0, 0, 1, 1, 1, 2, 2, 2, 3])):
        assert [r.shard for r in keys.contiguous_shards(spark.range(n), 4, "id").orderBy("id").collect()] == want
    for n, want in ((7, (4, 1, 2)), (10, (6, 2, 2))):
        got = {r.split: r["count"] for r in split.random_split(spark.range(n), Config().fractions, "1").groupBy("split").count().collect()}
        assert tuple(got[k] for k in ("train", "optimization", "test")) == want
    with pytest.raises(ValueError):
        require_unique(rows, ["a", "b"])


def _naive(cands, target, n, seed):
    import hashlib

    current, left, out = {}, list(cands), []
    lack = lambda x: max(0, target.get(x, 0) - current.get(x, 0))
    while left and len(out) < n:
        best = min(left, key=lambda x: (-(lack(x[0]) + lack(x[1])), hashlib.md5(f"{seed}|{x[0]}|{x[1]}".encode()).hexdigest()[: matched.TIE], x[0], x[1]))
        if lack(best[0]) + lack(best[1]) <= 0:
            break
        left.remove(best)
        out.append(best)
        for x in best[:2]:
            current[x] = current.get(x, 0) + 1
    return out


def test_degree_matched(spark):
    rng = random.Random(0)
    for _ in range(60):
        cands = sorted({tuple(sorted((rng.randrange(8), rng.randrange(8)))) for _ in range(15)})
        cands = [(*c, rng.randrange(5)) for c in cands]
        target = {i: rng.randrange(5) for i in range(6)}
        assert matched.pick_degree_matched(cands, target, 9, "s") == _naive(cands, target, 9, "s")
    cands = spark.createDataFrame([(1, 2, 9), (1, 3, 8), (1, 4, 7), (2, 3, 6), (3, 4, 5), (4, 4, 4)], "lo long, hi long, n long")
    positives = spark.createDataFrame([(1, 2), (1, 3), (1, 9)], "a long, b long")
    got = matched.select_degree_matched(cands, positives, 4).collect()
    assert {(r.lo, r.hi) for r in got} == {(1, 2), (1, 3), (1, 4)}


@pytest.mark.parametrize("n", [1, 2, 3, 9])
def test_degree_matched_reach(spark, n):
    rng = random.Random(n)
    cands = sorted({tuple(sorted((rng.randrange(40), int(40 * rng.random() ** 3)))) for _ in range(600)})
    cands = [(*c, rng.randrange(5)) for c in cands]
    ends = [(rng.randrange(30), int(30 * rng.random() ** 2)) for _ in range(120)]
    target = {}
    for a, b in ends:
        for x in {a, b}:
            target[x] = target.get(x, 0) + 1 + (a == b)
    got = matched.select_degree_matched(spark.createDataFrame(cands, "lo long, hi long, n long"), spark.createDataFrame(ends, "a long, b long"), n, "s")
    assert [(r.lo, r.hi, r.n) for r in got.orderBy("pick").collect()] == _naive(cands, target, n, "s")


@pytest.mark.parametrize("limit", [1, 40, 10**6])
def test_degree_matched_by_levels(spark, limit, monkeypatch):
    """Levels in Spark, several steps in one task, and all at once give the picks of the rule: hubs, self pairs, ends without a deficit, equal ties."""
    monkeypatch.setattr(matched, "LIMIT", limit)
    if limit == 40:
        monkeypatch.setattr(matched, "TIE", 1)
    rng = random.Random(limit)
    cands = sorted({tuple(sorted((rng.randrange(18), int(18 * rng.random() ** 2)))) for _ in range(140)})
    cands = [(*c, rng.randrange(5)) for c in cands]
    ends = [(rng.randrange(14), rng.choice([3, 3, 5, 7])) for _ in range(26)]
    target = collections.Counter(x for e in ends for x in e)
    for n in (3, 10**6):
        got = matched.select_degree_matched(spark.createDataFrame(cands, "lo long, hi long, n long"), spark.createDataFrame(ends, "a long, b long"), n, "s")
        want = _naive(cands, target, n, "s")
        assert [(r.lo, r.hi, r.n) for r in got.orderBy("pick").collect()] == want == matched.pick_degree_matched(cands, target, n, "s")


def test_pick_levels_of_large_lists():
    rng = np.random.default_rng(1)
    pairs = np.unique(np.sort(rng.integers(0, 120, (5000, 2)) ** 2 // 120, axis=1), axis=0)
    cands = [(int(a), int(b), 1) for a, b in pairs]
    target = {i: int(rng.integers(0, 40)) for i in range(100)}
    tie = [hashlib.md5(f"s|{a}|{b}".encode()).hexdigest()[: matched.TIE] for a, b, _ in cands]
    order = sorted(range(len(cands)), key=lambda k: (tie[k], cands[k]))
    a, b = pairs[order].T
    lack = np.array([target.get(i, 0) for i in range(120)])
    found, scores = matched.pick_levels(a, b, lack, 1, 10**6)
    assert (np.diff(scores) <= 0).all()
    ranked = [x for _, x in sorted(zip(zip(-scores, found, strict=True), found, strict=True))]
    assert [cands[order[k]] for k in ranked] == matched.pick_degree_matched(cands, target, 10**6, "s")


def test_degree_matched_without_target(spark):
    cands = spark.createDataFrame([(1, 2, 5), (1, 3, 9), (2, 3, 9)], "lo long, hi long, n long")
    none = spark.createDataFrame([], "a long, b long")
    assert [(r.pick, r.lo, r.hi) for r in matched.select_degree_matched(cands, none, 2).orderBy("pick").collect()] == [(0, 1, 3), (1, 2, 3)]
    assert matched.select_degree_matched(cands, none, 0).count() == 0


@pytest.mark.parametrize("of", [int, str])
@pytest.mark.parametrize("heavy, block, dense", [(100, 2048, 10), (1, 2048, 100), (1, 3, 100), (1, 3, 1), (5, 2, 100)])
def test_candidates(spark, heavy, block, dense, of):
    """Light and heavy genes, one tile and many, with the gene pairs as a dense matrix and without."""
    rng = random.Random(3)
    genes, feats = "ABCDE", {g: {of(rng.randrange(12)) for _ in range(5 + 3 * (g < "C"))} for g in "ABCDE"}
    pairs = [(rng.choice(genes), rng.choice(genes)) for _ in range(60)] + [("A", "Z"), ("Z", "Z")]
    allowed = [of(i) for i in range(10)]
    want = collections.Counter()
    for x, y in pairs:
        want.update({(min(f, g), max(f, g)) for f in feats.get(x, ()) for g in feats.get(y, ()) if f in allowed and g in allowed})
    resolved = spark.createDataFrame([(g, "P" + g, 1) for g in genes] + [("Z", "P", 2)], "gene string, accession string, n long")
    kind = "long" if of is int else "string"
    features = spark.createDataFrame([("P" + g, f) for g in genes for f in feats[g]], f"accession string, feature {kind}")
    edges = [(of(3), of(1)), (of(4), of(4)), (of(11), of(99))]
    tested, some = spark.createDataFrame(pairs, "bait string, prey string"), spark.createDataFrame([(x,) for x in allowed], f"feature {kind}")
    tiles = product.product_tiles(tested, resolved, features, some, spark.createDataFrame(edges, f"a {kind}, b {kind}"), heavy, block, dense)
    got = product.tile_candidates(tiles)
    assert got.schema["lo"].dataType.simpleString() == {"long": "bigint"}.get(kind, kind)
    rows = lambda df: [tuple(r) for r in df.collect()]
    assert {(lo, hi): n for lo, hi, n in rows(got)} == want and got.count() == len(want)
    fresh = {p: n for p, n in want.items() if p not in {(min(e), max(e)) for e in edges}}
    assert {(lo, hi): n for lo, hi, n in rows(product.tile_candidates(tiles, fresh=True))} == fresh
    best = sorted(((*p, n) for p, n in fresh.items()), key=lambda x: (-x[2], x[0], x[1]))
    for n in (0, 1, 7, 20, 10**6):
        assert rows(product.top_candidates(tiles, n)) == best[:n]
    assert rows(product.top_candidates(tiles, 1, fresh=False)) == [min(((*p, n) for p, n in want.items()), key=lambda x: (-x[2], x[0], x[1]))]


def test_candidates_of_nothing(spark):
    empty = lambda schema: spark.createDataFrame([], schema)
    tiles = product.product_tiles(empty("bait string, prey string"), empty("gene string, accession string, n long"), empty("accession string, feature long"), empty("feature long"), empty("a long, b long"))
    assert product.tile_candidates(tiles).collect() == product.top_candidates(tiles, 5).collect() == []


def test_gene_resolution(spark):
    entries = spark.createDataFrame([("P1", "A", ["B"]), ("P2", "X", ["B", "A"]), ("P3", None, ["C"])], "accession string, primary string, synonyms array<string>")
    wanted = spark.createDataFrame([("A",), ("B",), ("C",)], "gene string")
    found = negatives.matched_gene(entries, wanted)
    assert {(r.accession, r.gene) for r in found.collect()} == {("P1", "A"), ("P2", "B"), ("P3", "C")}


def _cut(edges, parts):
    return sum(x for a, b, x in edges if parts[a] != parts[b])


def test_partition(spark):
    rng = random.Random(1)
    edges = [(i, j, float(rng.randrange(1, 9))) for i in range(24) for j in range(i, 24) if i // 8 == j // 8 or rng.random() < 0.05]
    w = np.ones(24)
    targets = 24 * np.array([0.34, 0.33, 0.33])
    every = [np.array(c) for c in zip(*edges, strict=True)]
    labels = partition.balanced_kmeans(partition.spectral_coordinates(partition.laplacian(24, *every), 3), w, targets)
    a, b, x = (np.array(c) for c in zip(*[e for e in edges if e[0] != e[1]], strict=True))
    better = partition.refine(labels, w, a, b, x.astype(float), targets)
    assert _cut(edges, better) <= _cut(edges, labels)
    g = spark.createDataFrame(edges, "src long, dst long, w double")
    parts = partition.minimal_leakage(g, spark.createDataFrame([(i, 1) for i in range(24)], "cluster long, w long"), Config().fractions).collect()
    assert len(parts) == 24 and len({r.cluster for r in parts}) == 24
    vectors = partition.spectral_coordinates(lap := partition.laplacian(24, *every), 3)
    assert np.abs(lap @ vectors - vectors * np.einsum("ij,ij->j", vectors, lap @ vectors)).max() < 1e-9


def _graphs(n):
    """Two groups and a hub, degrees of a power law, a chain, and a star with leaves alone."""
    rng = np.random.default_rng(4)
    pairs = {(int(a), int(b)) for a, b in np.sort(rng.integers(0, n, (6 * n, 2)), axis=1) if a != b and (a % 2 == b % 2 or rng.random() < 0.05)}
    yield "hub", [(a, b, 1.0) for a, b in pairs] + [(0, i, 1.0) for i in range(1, n) if (0, i) not in pairs]
    law = (n * rng.random((4 * n, 2)) ** 3).astype(int)
    yield "law", [(a, b, float(x)) for (a, b), x in collections.Counter((int(a), int(b)) for a, b in np.sort(law, axis=1)).items()]
    yield "chain", [(i, i + 1, 1.0) for i in range(n - 1)]
    yield "star", [(0, i, 1.0) for i in range(1, n // 2)]


@pytest.mark.parametrize("graph_name, edges", list(_graphs(420)), ids=lambda x: x if isinstance(x, str) else "")
def test_partition_by_levels(spark, graph_name, edges):
    """Every cluster gets a part, parts keep their sizes, and the cut is no more than a twentieth over the dense one's."""
    n, fractions = 420, (("a", 0.6), ("b", 0.2), ("c", 0.2))
    weights = spark.createDataFrame([(i, 1 + i % 2) for i in range(n)], "cluster long, w long")
    frame = spark.createDataFrame([*edges, (3, 3, 50.0)], "src long, dst long, w double")
    whole, levelled = ({r.cluster: r.part for r in partition.minimal_leakage(frame, weights, fractions, dense=d).collect()} for d in (n, 250))
    assert sorted(levelled) == sorted(whole) == list(range(n))
    total = sum(1 + i % 2 for i in range(n))
    sizes = [{name: sum(1 + i % 2 for i in range(n) if parts[i] == name) / total for name, _ in fractions} for parts in (levelled, whole)]
    assert all(min(0.7 * share, 0.9 * sizes[1][name]) <= sizes[0][name] <= 1.15 * share for name, share in fractions), sizes
    assert _cut(edges, levelled) <= 1.05 * _cut(edges, whole) + 1


def test_clusters(spark):
    rng = random.Random(2)
    say = lambda n: "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))
    base = [say(60) for _ in range(3)]
    seqs = [(i * 10 + j, b if j == 0 else b[:j] + "A" + b[j + 1 :]) for i, b in enumerate(base) for j in range(4)] + [(99, say(60))]
    got = cluster.easy_cluster(spark.createDataFrame(seqs, "id long, seq string")).collect()
    assert {r.member: r.centroid for r in got} == {i: i // 10 * 10 if i < 90 else i for i, _ in seqs}
    assert cluster.align("ACDEFGHIK", "ACDEFGHIK") == (1.0, 1.0, 1.0)
    assert cluster.greedy_cover([(1, 5), (2, 5), (3, 9), (4, 1)], [(1, 2), (2, 3)]) == {2: 2, 1: 2, 3: 2, 4: 4}


def test_clusters_whole(spark):
    rng = random.Random(5)
    say = lambda n: "".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(n))
    motif = say(8)
    # 0 and 900 share a motif with all, which fails coverage with 0; the members differ in every third letter, so no 5-mer joins some of them
    base = say(45)
    far = lambda k: "".join(say(1) if i % 3 == k else c for i, c in enumerate(base))
    seqs = [(0, motif + say(200))] + [(10 + k, far(k)) for k in range(3)] + [(20 + k, motif + base[:30] + say(3)) for k in range(3)] + [(900, motif + say(60)), (901, base), (902, base), (903, ""), (904, None)]
    # a chain and a centre whose id is larger than a member's partner
    seqs += [(30 + k, "ACDEFGHIKL"[k : k + 7] + "MNPQRSTVWY"[: 2 * k]) for k in range(5)]
    seqs += [(100 + k, say(rng.randrange(1, 9))) for k in range(60)]
    known = {i: s for i, s in seqs if s}
    for identity, coverage in ((0.4, 0.8), (0.3, 0.6)):
        pairs = [(i, j) for i in known for j in known if i < j and all(v >= m for v, m in zip(cluster.align(known[i], known[j]), (identity, coverage, coverage), strict=True))]
        want = cluster.greedy_cover([(i, len(s)) for i, s in known.items()], pairs) | {903: 903, 904: 904}
        df = spark.createDataFrame(seqs, "id long, seq string")
        assert sorted((r.a, r.b) for r in cluster.similar_pairs(df, identity, coverage).collect()) == sorted(pairs)
        assert {r.member: r.centroid for r in cluster.easy_cluster(df, identity, coverage).collect()} == want


def test_cover_of_a_chain(spark):
    for nodes, pairs in (([1, 2, 3], [(1, 2), (2, 3)]), ([1, 2, 5, 9], [(1, 2), (2, 9), (5, 9)]), (list(range(12)), [(i, i + 1) for i in range(11)])):
        got = cluster.cover(spark.createDataFrame([(i, 5, 1) for i in nodes], "id long, length int, copies long"), spark.createDataFrame(pairs, "a long, b long"))
        assert {r.member: r.centroid for r in got.collect()} == cluster.greedy_cover([(i, 5) for i in nodes], pairs)


def test_align_many():
    rng = random.Random(7)
    rows = [tuple("".join(rng.choice("ACé") for _ in range(rng.randrange(0, 14))) for _ in range(2)) for _ in range(800)]
    got = cluster.align_many([a.encode() for a, _ in rows], [b.encode() for _, b in rows])
    for (a, b), g in zip(rows, got, strict=True):
        x, y = a.encode().decode("latin1"), b.encode().decode("latin1")
        assert tuple(g) == pytest.approx(cluster.align(a, b) if a.isascii() and b.isascii() else _bytes_align(x, y)), (a, b)


def _bytes_align(a: str, b: str) -> tuple[float, float, float]:
    """align() of strings whose letters stand for bytes."""
    other = {c: chr(33 + i) for i, c in enumerate(sorted(set(a + b)))}
    return cluster.align("".join(map(other.get, a)), "".join(map(other.get, b)))


def test_embed(spark):
    df = spark.createDataFrame([("a", "ACD"), ("b", ""), ("c", "A" * 50), ("d", None)], "seq_id string, seq string")
    got = {r.seq_id: r.embedding for r in embed.embed(df, lambda: embed.hash_model(4), max_length=40).collect()}
    assert len(got["a"]) == 4 and got["b"] is None and got["c"] is None and got["d"] is None
    full = embed.embed(df.limit(1), lambda: embed.hash_model(4), pooled=False)
    pooled = full.select(embed.mean_pool(F.col("embedding"), F.size("embedding")).alias("m")).first().m
    assert pooled == pytest.approx(got["a"], abs=1e-5)

    def fails(seqs):
        if len(seqs) > 1 or seqs == ["bad"]:
            raise MemoryError
        return [np.zeros((1, 2))]

    assert [x is None for x in embed.embed_with_halving(fails, ["x", "bad", "y"])] == [False, True, False]


def test_readers(spark, tmp_path):
    put = lambda name, text: (tmp_path / name).write_text(text) and str(tmp_path / name)
    assert [tuple(r) for r in readers.pair_list(spark, put("n.txt", "PF1 PF2 extra\nPF1\n\n")).collect()] == [("PF1", "PF2")]
    path = tmp_path / "PF00001.sto.gz"
    path.write_bytes(gzip.compress(b"# x\nABC_HUMAN/5-9  a.C-d\nNOCOORD  AAA\nX/5  AAA\nX/1-3 ...\n//\n"))
    assert [tuple(r)[:5] for r in readers.stockholm(spark, str(path)).collect()] == [("PF00001", "ABC_HUMAN", 5, 9, "ACD")]
    assert [tuple(r) for r in readers.id_mapping(spark, put("m.tsv", "P1\tGene\tA\nP2\tGene\tA\nP3\tX\tB\n"), "Gene").collect()] == [("A", "P2")]
    got = readers.fasta(spark, put("s.fasta", ">sp|P1|X desc\nAC\nDE\n>sp|P2|Y\n\n>plain z\nGG\n")).collect()
    assert [(r.accession, r.sequence) for r in got] == [("P1", "ACDE"), ("plain", "GG")]
    assert readers.protein_terms(spark, put("g.tsv", "Entry\tGene Ontology IDs\nP1\tGO:1; GO:2\nP2\t\n")).count() == 2
    assert [r.go_accession for r in readers.domain_terms(spark, put("p.txt", "! header\nPfam:PF1 Nm > GO:some term ; GO:0001  \n")).collect()] == ["GO:0001"]
    assert readers.links(spark, put("l.txt", "protein1 protein2 combined_score\na b 5\n")).first().combined_score == 5
    entry = '{"primaryAccession":"P1","genes":[{"geneName":{"value":"A"},"synonyms":[{"value":"B"}]}],"uniProtKBCrossReferences":[{"database":"Pfam","id":"PF1"},{"database":"GO","id":"x"}]}'
    r = readers.gene_entries(spark, put("e.json", entry)).first()
    assert (r.primary, r.synonyms, r.features) == ("A", ["B"], ["PF1"])
    c = readers.cluster_lines(spark, put("c.tsv", "1-5\t1-5\n1-5\t2-6\nbad\n3-1\t2-7\n"))
    assert {(r.domain, r.cluster) for r in graph.cluster_of(c).collect()} == {(1, 1), (2, 3)}


def test_dump(spark, tmp_path):
    text = "-- c\nCREATE TABLE `Domain` (\n  `Name` varchar(9),\n  `n` int,\n  PRIMARY KEY (`Name`)\n) ENGINE=x;\nINSERT INTO `Domain` VALUES ('it''s',1),('a\\nb;\n',2),(NULL,b'101');\nINSERT INTO `Other` VALUES (1);\n"
    (tmp_path / "d.sql.gz").write_bytes(gzip.compress(text.encode()))
    df = dump.mysql_table(spark, str(tmp_path / "d.sql.gz"), "Domain", "Name string, n long, more int")
    assert sorted(map(tuple, df.collect()), key=str) == sorted([("it's", 1, None), ("a\nb;\n", 2, None), (None, 5, None)], key=str)


@pytest.mark.parametrize("size", [40, 97, 1 << 20])
def test_dump_in_splits(spark, tmp_path, size):
    """Statements, literals and comments that cross the ends of splits."""
    rng = random.Random(4)
    bits = ["a", "\n", "''", "\\'", ";\n", "-- its", "`", '"', " ", "\\\\"]
    cells = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    text = "CREATE TABLE `t` (\n  `k` int,\n  `s` text\n);\n" + "".join(f"-- don't {k}\n\nINSERT INTO `t` VALUES ({k},'{c}'),\n({k + 100},'x');\nSET x=1;\n" for k, c in enumerate(cells))
    (tmp_path / "d.sql").write_text(text)
    want = list(dump.dump_rows(text.split("\n"), "t", ["k", "s"]))
    assert len(want) == 120
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        got = dump.mysql_table(spark, str(tmp_path / "d.sql"), "t", "k string, s string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(map(tuple, got)) == sorted(want)


def test_staging(spark):
    waits, calls = [], []

    def flaky(url):
        calls.append(url)
        if len(calls) < 4:
            raise OSError("no")
        return b"x"

    assert staging.with_retries(flaky, "u", wait=waits.append) == b"x" and waits == [2, 4, 8]

    def fetch(url):
        if "2" in url:
            raise OSError("gone")
        return url.encode()

    ids = spark.createDataFrame([("1",), ("2",), ("1",)], "id string")
    got = staging.fetched(ids, "http://h/{id}.gz", fetch, wait=lambda s: None)
    assert {r.id: (bytes(r.content) if r.content else None, r.error) for r in got.collect()} == {"1": (b"http://h/1.gz", None), "2": (None, "gone")}
    assert staging.require_some(got).count() == 1
    with pytest.raises(OSError):
        staging.require_some(staging.fetched(ids.filter("id = '2'"), "http://h/{id}.gz", fetch, wait=lambda s: None))


def test_versions_and_paths(spark):
    runs = sinks.versions(spark, "a", spark="4", python="3"), sinks.versions(spark, "b", spark="4"), sinks.versions(spark, "a", spark="4")
    assert {r.process: r.versions for r in sinks.versions_of(*runs).collect()} == {"a": {"python": "3", "spark": "4"}, "b": {"spark": "4"}}
    assert sinks.publish_path("out", "MAIN:SPLIT:CURATE_domains") == "out/curate"


def test_features_map_is_one_json_object(spark, tmp_path):
    import json

    sinks.write_features(spark.createDataFrame([('a"b', ["y", "x"]), ("c", []), (None, ["z"])], "accession string, features array<string>"), str(tmp_path / "f"))
    text = "\n".join(p.read_text() for p in sorted((tmp_path / "f").glob("part-*")))
    assert json.loads(text) == {'a"b': ["x", "y"], "c": []}


def test_config_and_database(spark):
    with pytest.raises(ValueError):
        Config(negatives_mode="x")
    assert '"seed": "42"' in Config().to_json()
    assert all(df.count() == 0 for df in empty_database(spark).tables().values())


def test_pipeline(spark):
    from pairloom.plans import pipeline
    from pairloom.schema import check

    make = lambda rows, kind: spark.createDataFrame(rows, kind)
    names = make([(f"d{i}", f"PF{i:05d}.{i}") for i in range(12)], "Name string, Pfam_id string")
    pos = make([(f"d{i}", f"d{(i + 1) % 12}") for i in range(12)], "domain1 string, domain2 string")
    neg = make([("PF00000", "PF00001"), ("PF00001", "PF00000"), ("PF00099", "PF00003")], "a string, b string")
    db = pipeline.ingest(empty_database(spark), pos, names, names.select(F.col("Name").alias("domain")), neg)
    assert db.domain.count() == 13 and db.ddi.count() == 14
    assert {(r.source, r["count"]) for r in db.ddi.groupBy("source").count().collect()} == {("3did", 12), ("negatome", 2)}
    rng = random.Random(3)
    seq = ["".join(rng.choice("ACDEFGHIKL") for _ in range(20)) for _ in range(13)]
    db = pipeline.add_proteins(db, make([(f"P{i}", s) for i, s in enumerate(seq)] + [("Q", "A")], "accession string, sequence string"), make([(f"P{i}",) for i in range(13)], "uniprot_id string"))
    ids = [r.pfam_id for r in db.domain.orderBy("id").collect()]
    db = pipeline.add_map(db, make([(p, f"P{i}", 1, 20, seq[i], i) for i, p in enumerate(ids)], "pfam_id string, uniprot_id string, start_pos int, end_pos int, sequence string, line_no long"))
    db = pipeline.add_terms(db, make([("PF00001", "GO:1"), ("PF00001", "GO:1"), ("x", "GO:2")], "pfam_id string, go_accession string"), make([("P1", "GO:3")], "uniprot_id string, go_accession string"))
    assert (db.domain_go_terms.count(), db.protein_go_terms.count()) == (2, 1)
    db = pipeline.add_ppis(db, make([("a", "b", 7), ("a", "zz", 1)], "protein1 string, protein2 string, combined_score int"), make([("a", "P1"), ("b", "P2")], "symbol string, uniprot_id string"))
    entries = make([(f"P{i}", f"G{i}", [], [ids[i]]) for i in range(12)], "accession string, primary string, synonyms array<string>, features array<string>")
    ppis = make([("G1", "G5", 3), ("G2", "G7", 3), ("G1", "G5", 1), ("G3", None, 9)], "bait string, prey string, n_tested int")
    db = pipeline.add_negatives(db, ppis, entries, Config(min_tested=1))
    assert db.ddi.filter("source = 'y2h_ms'").count() == 2
    check(db)
    for tables in (pipeline.random_splits(db, Config()), pipeline.minimal_leakage_splits(db, Config())):
        assert {"train"} <= {r.split for r in tables["ddi"].select("split").distinct().collect()}
        assert tables["ddi"].select("id").distinct().count() == tables["ddi"].count() <= db.ddi.count()
    leak = tables["ddi"].select("split", F.explode(F.array("domain_id_a", "domain_id_b")).alias("d")).distinct().groupBy("d").count().filter("count > 1")
    assert leak.count() == 0
    small = split.smoke_filter(db, 4, "1")
    assert small.ddi.count() == 4


def _align_by_cell(a: str, b: str) -> tuple[float, float, float]:
    """Identity of the best local alignment (match 2, mismatch -1, gap -2) and its coverage of both sequences."""
    x, y = np.frombuffer(a.encode(), np.uint8), np.frombuffer(b.encode(), np.uint8)
    score = np.zeros(len(y) + 1, np.int64)
    # of the best alignment that ends in a cell: first places in a and b, and matches
    fa, fb, same = (np.zeros(len(y) + 1, np.int64) for _ in range(3))
    best = (0, 0, 0, 0, 0, 0)
    for i in range(len(x)):
        s, a0, b0, m = np.zeros_like(score), np.zeros_like(fa), np.zeros_like(fb), np.zeros_like(same)
        for j in range(1, len(y) + 1):
            hit = x[i] == y[j - 1]
            options = ((score[j - 1] + (2 if hit else -1), 0), (score[j] - 2, 1), (s[j - 1] - 2, 2))
            top, way = max(options, key=lambda o: (o[0], -o[1]))
            if top <= 0:
                continue
            s[j] = top
            if way == 0:
                fresh = score[j - 1] == 0
                a0[j], b0[j], m[j] = (i, j - 1, 0) if fresh else (fa[j - 1], fb[j - 1], same[j - 1])
                m[j] += hit
            else:
                src = (fa[j], fb[j], same[j]) if way == 1 else (a0[j - 1], b0[j - 1], m[j - 1])
                a0[j], b0[j], m[j] = src
            if top > best[0]:
                best = (top, a0[j], i + 1, b0[j], j, m[j])
        score, fa, fb, same = s, a0, b0, m
    if not best[0]:
        return 0.0, 0.0, 0.0
    la, lb = best[2] - best[1], best[4] - best[3]
    return float(best[5]) / max(la, lb), la / len(a), lb / len(b)


def test_align_matches_cell_by_cell():
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ACD") for _ in range(n))
    pairs = [(word(rng.randrange(0, 30)), word(rng.randrange(0, 30))) for _ in range(300)] + [("", ""), ("A", ""), ("", "A"), ("A", "A"), ("A", "C")]
    base = word(60)
    pairs += [(base, base[:20] + base[25:]), (base[5:], base), (base, base)]
    for a, b in pairs:
        assert cluster.align(a, b) == _align_by_cell(a, b), (a, b)


def test_product_of_ids_is_dealt_out(spark, monkeypatch):
    """Small inputs with a large product are made by several tasks, whole: repeated pairs, repeated and null ids too."""
    from pairloom.plans import pipeline

    monkeypatch.setattr(pipeline, "IDS", 7)
    monkeypatch.setattr(pipeline, "PRODUCT_ROWS", 200)
    names = [("x", i) for i in range(50)] + [("y", i % 20) for i in range(40)] + [("x", None), ("z", 1), (None, 2)]
    pairs = [("x", "y"), ("x", "y"), ("x", "x"), ("x", "w"), (None, "z"), ("z", "z")]
    got = pipeline.ids_of_pairs(spark.createDataFrame(pairs, "a string, b string"), spark.createDataFrame(names, "name string, id long"))
    want = [(a, b, i, j) for a, b in pairs if a and b for n, i in names if n == a for m, j in names if m == b]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert got.select(F.spark_partition_id()).distinct().count() > 5


def test_tiles_give_slices(spark, monkeypatch):
    """Stored packs are compressed bytes, a tile's candidates come in slices, and stored pairs are counted in the tiles."""
    monkeypatch.setattr(product, "SLICE", 64)
    make = lambda rows, kind: spark.createDataFrame(rows, kind)
    features = make([(f"P{g}", f) for g in range(3) for f in range(40) if (f + g) % 3], "accession string, feature long")
    resolved = make([(f"G{g}", f"P{g}", 1) for g in range(3)], "gene string, accession string, n long")
    edges = make([(0, 1), (1, 0), (5, 3), (2, 99)], "a long, b long")
    tiles = product.product_tiles(make([("G0", "G1"), ("G1", "G2")], "bait string, prey string"), resolved, features, features.select("feature").distinct(), edges, 5, 16, 2)
    assert dict(tiles.dtypes)["data"] == "binary"
    found = {(r.lo, r.hi) for r in product.tile_candidates(tiles).collect()}
    assert product.overlap(tiles).first().n_overlap == len(found & {(0, 1), (3, 5)}) > 0
    part = tiles.filter("i = 0 AND j = 1").select("kind", "data").toArrow().to_batches()
    sizes = [len(n) for _, _, n in product._Tile(0, 1, 16, 2, iter(part)).counts(False)]
    assert len(sizes) == 4 and 0 < max(sizes) <= 64


def test_product_stores_packs_once(spark, monkeypatch):
    """Packs are copied for their tiles when these are dealt out, in portions; what only led to them is gone by then, as is what was shuffled."""
    import os

    folder = keys.fresh_path(spark).rsplit("/", 1)[0].removeprefix("file:")
    tables = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    make, before = lambda rows, kind: spark.createDataFrame(rows, kind), tables()
    features = make([(f"P{g}", f) for g in range(6) for f in range(60) if (f * 7 + g) % 3], "accession string, feature long")
    resolved = make([(f"G{g}", f"P{g}", 1) for g in range(6)], "gene string, accession string, n long")
    pairs = make([(f"G{g}", f"G{h}") for g in range(6) for h in range(g, 6) for _ in range(g * h % 4)], "bait string, prey string")
    edges = make([(0, 1), (1, 0), (5, 3), (2, 99)], "a long, b long")
    tiles = product.product_tiles(pairs, resolved, features, features.select("feature").distinct(), edges, 5, 16, 2)
    # two more are the ranges of the numbers
    assert len(tables() - before) <= 6
    packs = lambda: tiles.filter("kind = 2")
    assert packs().count() > packs().select("data").distinct().count() > 0
    assert spark.conf.get(keys._CLEANUP) == "false"

    want = sorted(map(tuple, product.tile_candidates(tiles, fresh=True).collect()), key=lambda x: (-x[2], x[0], x[1]))
    monkeypatch.setattr(product, "PORTION", tiles.agg(F.sum(F.length("data"))).first()[0] // 4 + 1)
    before = tables()
    for n in (1, 40, len(want) - 1):
        assert list(map(tuple, product.top_candidates(tiles, n).collect())) == want[:n]
    # a table of counts and one of pairs for each of the portions
    assert len(tables() - before) == 3 * 2 * 4


def test_first_candidates_in_one_pass(spark, monkeypatch):
    """Tiles are multiplied once, each in a task of its own, and give what a table of all gives; single precision where it is exact."""
    import pyarrow as pa

    make, times = lambda rows, kind: spark.createDataFrame(rows, kind), 1 << 23
    features = make([(f"P{g}", f) for g in range(6) for f in range(60) if (f * 7 + g) % 3], "accession string, feature long")
    resolved = make([(f"G{g}", f"P{g}", 1) for g in range(6)], "gene string, accession string, n long")
    pairs = make([(f"G{g}", f"G{h}") for g in range(6) for h in range(g, 6) for _ in range(g * h % 4)], "bait string, prey string")
    tiles = product.product_tiles(pairs, resolved, features, features.select("feature").distinct(), None, 5, 16, 2)
    want = sorted(map(tuple, product.tile_candidates(tiles).collect()), key=lambda x: (-x[2], x[0], x[1]))
    monkeypatch.setattr(product, "SLICE", 64)
    passes, dealt = [], product._of_tiles
    monkeypatch.setattr(product, "_of_tiles", lambda *args: passes.append(dealt(*args)) or passes[-1])
    for n in (1, 40):
        assert list(map(tuple, product.first_candidates(tiles, n, fresh=False).collect())) == want[:n]
    assert len(passes) == 2 and passes[0].rdd.getNumPartitions() == tiles.select("i", "j").distinct().count() > 4

    def tile(n: int) -> np.ndarray:
        out = product._Tile(0, 0, 4, 9, iter(()))
        for kind, x, y, count in ((product._HAS, [0, 0, 1, 1], [0, 1, 1, 2], [0] * 4), (product._TIMES, [0], [1], [n])):
            out.parts[kind] = [pa.table({"x": x, "y": y, "n": count})]
        return out._total()

    small, large = tile(5), tile(2 * times + 1)
    assert (small.dtype, large.dtype) == (np.float32, np.float64) and (small.astype(float) / 5 * (2 * times + 1) == large).all() and small[0, 1] == small[1, 1] == small[0, 2] == 5


def test_frequency_counts_what_is_missing(spark):
    edges = lambda *rows: spark.createDataFrame(rows, "negative boolean, source string")
    assert negatives.missing(edges((False, "3did"), (False, "negatome"), (True, "negatome"), (True, "y2h_ms"), (None, "negatome"))) == 1
    assert negatives.missing(edges((True, "negatome"))) == -1
    assert negatives.missing(edges((True, None)).limit(0)) == 0


def test_partition_leaves_few_tables(spark):
    """Tables of rounds and levels go as soon as nothing reads them."""
    import os

    folder = keys.fresh_path(spark).rsplit("/", 1)[0].removeprefix("file:")
    tables = lambda: set(os.listdir(folder)) if os.path.isdir(folder) else set()
    before = tables()
    nodes = spark.range(60).select(F.col("id").alias("node"), F.lit(1.0).alias("w"))
    edges = spark.range(59).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"), F.lit(1.0).alias("x"))
    into = partition.merged(nodes, edges, 4.0, 60)
    assert len(tables() - before) == 1 and into.count() == 60
    parts = partition.moved(nodes, edges, nodes.select("node", (F.col("node") % 3).cast("int").alias("part")), np.array([20.0, 20.0, 20.0]), 0.5)
    assert len(tables() - before) <= 2 and parts.count() == 60
