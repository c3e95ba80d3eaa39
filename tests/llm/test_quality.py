import random
import re

import numpy as np
import pyarrow as pa
import pytest

from limnia.llm import quality as q

TOKEN = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+|[^0-9A-Za-z\x80-\U0010ffff\x20\x09-\x0d]+")


def plain_counts(text):
    """Sorted counts of distinct tokens and token pairs, by definition."""
    words = TOKEN.findall(text or "")
    grams = [(w,) for w in words] + list(zip(words, words[1:], strict=False))
    return sorted(np.unique([" ".join(g) + f"/{len(g)}" for g in grams], return_counts=True)[1].tolist()) if grams else []


def counts(f, i):
    at, x = f.of(i)
    assert at[-1] == q.BUCKETS and x[-1] == 1 and len(set(at.tolist())) == len(at)
    assert len(x) == 1 or abs((x[:-1] ** 2).sum() - 1) < 1e-9
    return x[:-1]


@pytest.mark.parametrize("seed", range(10))
def test_features_equal_plain_counts(seed):
    rnd = random.Random(seed)
    parts = ["a", "B", "é", "a1", "!", "&&", "don't", "A-b", " ", "\n", "\x85", "  ", "😀"]
    texts = ["".join(rnd.choice(parts) + rnd.choice(["", " "]) for _ in range(rnd.randrange(0, 60))) for _ in range(30)] + [None, "", " "]
    f = q.features(pa.array(texts))
    for i, t in enumerate(texts):
        want = np.log1p(plain_counts(t))
        got = np.sort(counts(f, i))
        assert np.allclose(got, np.sort(want) / (np.sqrt((want**2).sum()) if len(want) else 1))


def test_windows_count_the_same():
    rnd = random.Random(3)
    text = "".join(rnd.choice(["ab", "C", "!!", "é", "x" * 30]) + rnd.choice([" ", "\n", ""]) for _ in range(2000))
    whole = q.features(pa.array([text]))
    for window in (1, 7, 50, 1000):
        cut = q.features(pa.array([text]), window)
        assert np.array_equal(whole.buckets, cut.buckets) and np.allclose(whole.values, cut.values)


def test_leader_equals_plain_updates():
    rng = np.random.default_rng(1)
    leader = q.Leader(np.zeros(6), np.zeros(6))
    z, n = [0.0] * 6, [0.0] * 6
    for _ in range(50):
        at, x, y = rng.permutation(6)[:3], rng.normal(size=3), int(rng.integers(2))
        leader.learn(at, x, y)
        w = {i: -np.sign(z[i]) * max(0, abs(z[i]) - q.L1) / ((q.SMOOTH + n[i] ** 0.5) / q.STEP + q.L2) for i in at}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(at, x, strict=True))))
        for i, v in zip(at, x, strict=True):
            g = (p - y) * v
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / q.STEP * w[i]
            n[i] += g * g
    assert np.allclose(leader.z, z) and np.allclose(leader.n, n)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(1)
    words = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(1500):
        w = [rnd.choice(words) for _ in range(rnd.choice([10, 60, 300]))]
        if i % 5 == 0:
            w = [x.upper() + "!!" if rnd.random() < 0.5 else x for x in w]
        rows.append((i, " ".join(w), 0.5))
        if i % 3:
            labels.append((i, int(i % 5 > 0), "x"))
    rows += [(9001, None, 1.0), (9002, "", 1.0), (None, "word1 word2", 1.0), (9003, "word1 " * 300_000, 1.0), (5, rows[5][1], 0.5), (6, "WORD1!!", 0.0)]
    labels += [(5, 1, "x"), (5, 0, "y"), (None, 1, "z"), (7, None, "z"), (77_777, 1, "none")]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, _score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, text string"),
    )


def test_held_out_accuracy(data):
    docs, labels = data
    out = q.score(docs, q.train(docs, labels))
    assert out.columns == ["doc_id", "text", "_score"]
    rows = out.collect()
    assert len(rows) == 1506 and all(0 <= r["_score"] <= 1 for r in rows)
    unseen = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 9000 and r["doc_id"] % 3 == 0 and r["text"] != "WORD1!!"]
    assert np.mean([(r["_score"] >= 0.5) == (r["doc_id"] % 5 > 0) for r in unseen]) > 0.97
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["_score"])
    assert all(len(s) == 1 for s in by_text.values())


def test_same_weights_however_dealt(data):
    docs, labels = data
    a = q.train(docs, labels)
    assert np.allclose(a, q.train(docs.repartition(7), labels.repartition(3)), rtol=1e-4, atol=1e-5)
    assert not np.allclose(a, q.train(docs, labels, limit=100), atol=1e-3)


def test_one_id_on_many_rows_trains_once(data, spark):
    docs, labels = data
    many = docs.select("doc_id", "text").union(spark.range(3000).selectExpr("CAST(1 AS long)", "concat('copy ', id % 3)"))
    assert q.labelled(many, labels).count() == q.labelled(docs, labels).count()


def test_nothing_to_learn(data):
    docs, labels = data
    assert {r["_score"] for r in q.score(docs, q.train(docs, labels.limit(0))).collect()} == {0.5}
    assert q.score(docs.limit(0), q.train(docs, labels)).collect() == []


def test_train_equals_plain_rounds(data):
    docs, labels = data
    rows = sorted(q.labelled(docs, labels).collect(), key=lambda r: (r["shard"], r["place"]))
    z, n = np.zeros(q.BUCKETS + 1), np.zeros(q.BUCKETS + 1)
    for _ in range(q.ROUNDS):
        dz, dn, met = np.zeros_like(z), np.zeros_like(z), np.zeros_like(z)
        for s in {r["shard"] for r in rows}:
            own = q.Leader(z.copy(), n.copy())
            for r in rows:
                if r["shard"] == s:
                    own.learn(*q.features(pa.array([r["text"]])).of(0), r["label"])
            dz, dn, met = dz + own.z - z, dn + own.n - n, met + (own.n > n)
        z, n = z + dz / np.maximum(met, 1), n + dn / np.maximum(met, 1)
    assert np.allclose(q.train(docs, labels), q.Leader(z, n).weights(), rtol=1e-3, atol=1e-5)
