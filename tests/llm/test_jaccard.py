import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from limnia.llm import graph, jaccard


def shingles(text, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def plain(rows, size=4, threshold=85):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= threshold * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    label = {}
    for i, (d, _) in enumerate(rows):
        label.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in label[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def key(r):
    return tuple((x is None, x or 0) for x in r)


def copies(seed, n):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(400)}"
    passage = " ".join(word() for _ in range(60))
    texts = []
    while len(texts) < n:
        base = [word() for _ in range(rnd.choice([1, 3, 4, 5, 8, 9, 10, 11, 14, 30, 60, 150, 400]))]
        if rnd.random() < 0.2:
            base += passage.split()
        for _ in range(rnd.choice([1, 1, 2, 3, 12])):
            t = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 4, 8])):
                if t:
                    at = rnd.randrange(len(t))
                    t[at : at + 1] = rnd.choice([[], [word()], [t[at], word()]])
            texts.append(" ".join(t))
    rows = [(rnd.randrange(10**6), t) for t in texts]
    return rows + [(1, None), (2, ""), (3, " \t\n"), (None, texts[0]), (None, "alone and without an id"), (rows[0][0], rows[0][1]), (4, "A b C d"), (5, "a B c D")]


@pytest.mark.parametrize("seed,large,block,size,threshold", [(1, 64, 1024, 4, 85), (2, 3, 16, 5, 80), (3, 1, 5, 4, 85)])
def test_groups_equal_brute_force(spark, monkeypatch, seed, large, block, size, threshold):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "COLUMNS", 37)
    rows = copies(seed, 260)
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, id int, n int")
    got = sorted((tuple(r) for r in jaccard.groups(docs, size, threshold, large).collect()), key=key)
    assert got == sorted(plain(rows, size, threshold), key=key)


def test_every_linked_pair_shares_a_signature():
    rng = np.random.default_rng(5)
    for t in (85, 80, 70):
        schemes = jaccard.Schemes(t)
        for _ in range(3000):
            n = int(rng.integers(1, 120))
            s = rng.integers(0, 1 << 62, n + 60).astype(np.uint64)
            drop = int(rng.integers(0, 1 + n // 5))
            a, b = np.unique(s[:n]), np.unique(np.concatenate([s[drop:n], s[n : n + int(rng.integers(0, 1 + n // 8))]]))
            common = len(np.intersect1d(a, b))
            if 100 * common >= t * (len(a) + len(b) - common) and not np.array_equal(a, b):
                x, y = jaccard.signatures(a, schemes)[0], jaccard.signatures(b, schemes)[0]
                assert len(np.intersect1d(x, y)), (len(a), len(b), common)


def test_leaving_large_buckets_keeps_a_signature():
    """Whatever signatures are called large, a set that has no more than it can spare still shares another one."""
    rng = np.random.default_rng(6)
    schemes = jaccard.Schemes(85)
    for _ in range(1500):
        n = int(rng.integers(10, 200))
        s = rng.integers(0, 1 << 62, n).astype(np.uint64)
        a, b = np.unique(s), np.unique(s[int(rng.integers(0, n // 8)) :])
        (x, left_x), (y, left_y) = jaccard.signatures(a, schemes), jaccard.signatures(b, schemes)
        common = np.intersect1d(x, y)
        banned = common[rng.random(len(common)) < 0.5]
        may_x, may_y = dict(left_x), dict(left_y)

        def keeps(sig, own, may):
            band = int(sig) & 255
            if band == jaccard.DELETIONS or sig not in banned:
                return True
            return sum(int(z) & 255 == band for z in banned if z in own) > max(0, may[band])

        if not np.array_equal(a, b) and 100 * len(b) >= 85 * len(a):
            assert any(keeps(z, x, may_x) and keeps(z, y, may_y) for z in common)


def test_linked_blocks_across():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 50).astype(np.uint64)
    sets = [np.unique(x) for x in (base, rng.integers(0, 9, 5).astype(np.uint64), base[:46], base[3:])]
    assert jaccard.linked_blocks(sets, 2, 85).tolist() == [0, 1, 0, 0]
    assert jaccard.linked_blocks(sets, 0, 85).tolist() == [0, 1, 0, 0]


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(500 + i, 500 + rnd.randrange(40)) for i in range(40)] + [(7, 7)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}
    for u, v in edges:
        root.setdefault(u, u), root.setdefault(v, v)
    for _ in range(200):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    linked = {x for u, v in edges if u != v for x in (u, v)}
    assert got == {k: v for k, v in root.items() if k in linked}


def test_components_of_edges_whose_hashes_sum_up_beyond_64_bits(spark):
    edges = spark.range(6000).selectExpr("2 * id + 1 AS u", "2 * id AS v").filter("xxhash64(u, v) > (1L << 62)")
    n = edges.count()
    assert n > 1100  # eighth bits and up, summed: more than 1100 << 54
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert len(got) == 2 * n and all(root == node - node % 2 for node, root in got.items())


def test_marks_of_edges(spark):
    edges = [(i, i * 7 % 50) for i in range(200)]
    mark = lambda e: graph._mark(spark.createDataFrame(e, "u long, v long"))
    assert mark(edges) == mark(edges[::-1])
    others = (edges[1:], [*edges, edges[0]], [(1000, 7), *edges[1:]], [edges[0][::-1], (edges[1][0], edges[1][1] + 1), *edges[2:]])
    assert all(mark(e) != mark(edges) for e in others)


def test_keep_one(spark):
    rows = copies(9, 120)
    docs = spark.createDataFrame([(d, t, i, "x") for i, (d, t) in enumerate(rows)], "doc_id long, text string, rid int, id string")
    out = jaccard.keep_one(docs)
    assert out.columns == docs.columns
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out.collect())
    groups = {}
    for (d, n, c), i in zip(plain(rows), range(len(rows))):
        groups.setdefault((c, i if n == 0 or c is None else -1), []).append(d)
    want = sorted((c is None, c or 0) for c, _ in groups)
    assert kept == want


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.groups(none).collect() == [] and jaccard.keep_one(none).collect() == []
    assert [len(s) for s in jaccard.shingle_sets(pa.array([None, "a", "a b c d e"]), 4)] == [0, 1, 2]


def test_bands_as_columns(spark):
    for t in (85, 80):
        sizes = spark.range(1, 400).selectExpr("id AS n")
        got = {r["n"]: r["b"] for r in sizes.select("n", jaccard.Schemes(t).columns(F.col("n"), 399).alias("b")).collect()}
        schemes = jaccard.Schemes(t)
        assert got == {n: schemes.of(n) for n in range(1, 400)}
