import random

import numpy as np
import pytest

from limnia.llm import toxicity as tox


def plain_segments(s):
    """Maximal segments by definition: repeatedly the best segment, then left and right of it."""
    out = []

    def inside(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += s[j]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9 or abs(total - best[0]) <= 1e-9 and j + 1 - i < best[2] - best[1]):
                    best = (total, i, j + 1)
        if best:
            inside(a, best[1])
            out.append((best[1], best[2], best[0]))
            inside(best[2], b)

    inside(0, len(s))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_segments_equal_definition(seed):
    rnd = np.random.default_rng(seed)
    s = np.round(rnd.normal(-0.3, 1, rnd.integers(0, 40)), 6)
    got = tox.maximal_segments(s)
    want = plain_segments(s.tolist())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in got], [x[2] for x in want])


def test_monotone():
    x, y = np.array([1.0, 1, 2, 3, 4, 5]), np.array([0.0, 1, 0, 1, 0, 1])
    steps, chances = tox.monotone(x, y)
    assert steps.tolist() == [1, 3, 5] and np.allclose(chances, [1 / 3, 0.5, 1])
    assert (np.diff(chances) > 0).all()


def test_tail_law_holds_for_random_text():
    rng = np.random.default_rng(1)
    usual = np.array([900.0, 90, 10])
    weights = np.array([-0.2, 0.5, 2.0])
    lam, log_k = tox.tail(weights, usual)
    best = []
    for _ in range(2000):
        s = weights[rng.choice(3, 300, p=usual / usual.sum())]
        best.append(max([x[2] for x in tox.maximal_segments(s)], default=0))
    for q in (0.5, 0.9, 0.99):
        s = np.quantile(best, q)
        assert 1 - np.exp(-np.exp(np.log(300) + log_k - lam * s)) >= 0.5 * (1 - q)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(1)
    clean = [f"word{i}" for i in range(300)]
    bad = ["vile", "awful", "nasty"]
    rows, labels = [], []
    for i in range(1500):
        w = [rnd.choice(clean) for _ in range(rnd.choice([10, 60, 300]))]
        toxic = i % 5 == 0
        if toxic:
            at = rnd.randrange(len(w))
            w[at:at] = rnd.choices(bad, k=4)
        rows.append((i, " ".join(w), 3))
        if i % 3:
            labels.append((i, int(toxic), "x"))
    rows += [(9001, None, 1), (9002, "", 1), (None, "vile awful nasty vile", 1), (9003, "word1 " * 50000, 1), (5, rows[5][1], 3)]
    labels += [(5, 1, "x"), (5, 0, "y"), (None, 1, "z"), (7, None, "z")]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, fold int"),
        spark.createDataFrame(labels, "doc_id long, toxic int, text string"),
    )


def test_held_out_accuracy(data):
    docs, labels = data
    out = tox.evidence(docs, tox.train(docs, labels))
    assert out.columns == ["doc_id", "text", "fold", "_evidence", "_score", "_passages"]
    rows = out.collect()
    assert len(rows) == 1505
    unseen = [r for r in rows if r["doc_id"] is not None and r["doc_id"] < 9000 and r["doc_id"] % 3 == 0]
    right = [(r["_score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in unseen]
    assert np.mean(right) > 0.97
    for r in rows:
        assert 0 <= r["_score"] <= 1
        for p in r["_passages"]:
            words = (r["text"] or "").split(" ")[p["start"] : p["end"]]
            assert words[0] in ("vile", "awful", "nasty") or p["p"] <= 0.05
    low = min(r["_score"] for r in rows)
    assert all(r["_score"] == low for r in rows if not r["text"] or r["doc_id"] == 9003)
    assert all(r["_score"] > 0.3 for r in rows if r["doc_id"] is None)


def test_nothing_to_learn(data):
    docs, labels = data
    assert {r["_score"] for r in tox.evidence(docs, tox.train(docs, labels.limit(0))).collect()} == {0.0}
    assert tox.evidence(docs.limit(0), tox.train(docs, labels)).collect() == []


def test_usual_frequencies_come_from_all_documents(data, spark):
    docs, labels = data
    counts = {}
    for r in docs.collect():
        for w in (r["text"] or "").split():
            counts[w] = counts.get(w, 0) + 1
    in_docs, usual = tox.usual_counts(docs)
    assert in_docs.max() <= docs.count() and (in_docs <= usual).all()
    assert usual.sum() == sum(counts.values()) and usual.max() == max(counts.values())
    # unlabelled text moves the law of chance passages, labels being the same
    more = docs.select("doc_id", "text").union(spark.range(200).selectExpr("id + 50000", "repeat('vile ', 300)"))
    assert tox.train(docs, labels).lam > 2 * tox.train(more, labels).lam


def test_one_id_on_many_rows_trains_once(data, spark):
    docs, labels = data
    many = docs.select("doc_id", "text").union(spark.range(3000).selectExpr("CAST(1 AS long)", "concat('copy ', id % 3)"))
    assert tox.labelled(many, labels).count() == tox.labelled(docs, labels).count()
