import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from limnia.llm import lm


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def test_filter_counts():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, 20000)
    counts = np.maximum(2, rng.pareto(0.7, 20000) * 3).astype(np.int64)
    n_blocks = 2
    blocks = np.zeros((n_blocks, lm.BLOCK_BITS // 8), np.uint8)
    at = lm.LogFrequencyFilter.block_of(keys, n_blocks)
    for b in range(n_blocks):
        blocks[b] = np.frombuffer(lm.LogFrequencyFilter.fill(keys[at == b], counts[at == b], 2.0).tobytes(), np.uint8)
    f = lm.LogFrequencyFilter(blocks, 2.0)
    got = f.count(keys)
    exact = lm.LogFrequencyFilter.value(lm.LogFrequencyFilter.level(counts, 2.0), 2.0)
    assert (got >= exact).all() and (got == exact).mean() > 0.97
    assert (exact <= counts).all() and (counts < exact * lm.STEP + 1e-6).all()
    assert (f.count(rng.integers(-(1 << 62), 1 << 62, 20000)) > 0).mean() < 0.03


def markov(rnd, n):
    out, w = [], 0
    for _ in range(n):
        w = (w * 3 + rnd.choice([1, 1, 1, 2, 5])) % 40
        out.append(f"Tok{w}")
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    made = [(i, markov(rnd, rnd.randrange(5, 200)), 3) for i in range(400)]
    return made + [(500, None, 1), (501, "", 1), (502, "new words Only here here", 1), (None, "tok1", 1), (3, made[3][1], 3), (503, "x " * 60000, 1)]


@pytest.mark.parametrize("common", [2.0**-21, 0.02])
def test_scores(spark, rows, monkeypatch, common):
    monkeypatch.setattr(lm, "COMMON", common)
    monkeypatch.setattr(lm, "VOCABULARY", max(common, lm.VOCABULARY))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int")
    train = docs.filter("doc_id % 10 <> 0 AND doc_id < 500")
    model, counts = lm.train(train)
    known = Counter(t for d, x, _ in rows if d is not None and d % 10 and d < 500 for t in tokens(x))
    total, distinct = sum(known.values()), len(known)
    assert (model.n, model.v) == (total, distinct)
    out = lm.score(docs, model, counts)
    assert out.columns == ["doc_id", "text", "n", "_n_tokens", "_n_known", "_base", "_score"]
    got = out.collect()
    assert len(got) == len(rows)
    gain = 0.0
    for r in got:
        t = tokens(r["text"])
        base = sum(math.log10((known[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in t)
        assert r["_n_tokens"] == len(t) and r["_n_known"] == sum(known[x] > 0 for x in t)
        assert math.isclose(r["_base"], base, rel_tol=1e-9)
        assert r["_score"] < 0
        if r["doc_id"] is not None and r["doc_id"] < 500 and r["doc_id"] % 10 == 0:
            gain += (r["_score"] - r["_base"]) / len(t)
    assert gain > 0 if common > 0.01 else gain > 5


def test_probabilities_sum_to_one_at_most(spark, rows):
    docs = spark.createDataFrame(rows[:300], "doc_id long, text string, n int")
    m, _ = lm.train(docs)
    f = lm.LogFrequencyFilter(m.blocks, m.unit)
    for u in range(len(m.keys)):
        at = np.arange(len(m.keys))
        share = f.count(m.code(np.full(len(at), u), at)) / m.counts[u]
        assert (m.weight[u] * share + (1 - m.weight[u]) * m.base(m.counts)).sum() < 1.02


def test_no_training(spark, rows):
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string, n int")
    model, counts = lm.train(docs.limit(0))
    assert [(r["_base"], r["_score"], r["_n_known"]) for r in lm.score(docs, model, counts).collect()] == [(0.0, 0.0, 0)] * 5
    model, counts = lm.train(docs)
    assert lm.score(docs.limit(0), model, counts).collect() == []


def test_rare_pairs_and_tokens_count_the_same_by_every_way(spark, rows, monkeypatch):
    """Where a pair or token is kept doesn't change a text's score: all broadcast, some, or none but the join."""
    docs = spark.createDataFrame(rows[:350], "doc_id long, text string, n int")
    scores = []
    for common, vocabulary, pair_common in ((2.0**-21, 2.0**-17, 2.0**-24), (2.0**-21, 0.02, 2.0**-24), (2.0**-21, 2.0**-17, 2.0**-9), (0.03, 0.03, 0.5)):
        monkeypatch.setattr(lm, "COMMON", common)
        monkeypatch.setattr(lm, "VOCABULARY", vocabulary)
        monkeypatch.setattr(lm, "PAIR_COMMON", pair_common)
        monkeypatch.setattr(lm, "PROBES", 24)  # no false hits
        model, counts = lm.train(docs)
        scores.append({r["doc_id"]: r["_score"] for r in lm.score(docs, model, counts).collect()})
    for other in scores[1:]:
        assert all(math.isclose(x, other[i], rel_tol=1e-9) for i, x in scores[0].items())


@pytest.mark.parametrize("pair_common", [2.0**-26, 2.0**-8])
def test_pairs_without_evidence_are_not_looked_up(spark, monkeypatch, pair_common):
    """Pairs that occur once meet no join, whether the filter has all the others or the screen some."""
    monkeypatch.setattr(lm, "PAIR_COMMON", pair_common)
    monkeypatch.setattr(lm, "SERVED", 1, raising=False)  # or the repeated pairs of these few texts are looked up
    kept = []
    monkeypatch.setattr(lm, "stored", lambda df, store=lm.stored: kept.append(store(df)) or kept[-1])
    rnd = random.Random(5)

    def word():
        i = rnd.randrange(60)
        return f"x{i} y{i} z{rnd.randrange(300)}"  # x and y go together, most other pairs are found once

    texts = [" ".join(word() for _ in range(8)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, counts = lm.train(docs)
    assert model.weight.max() >= 0.3 and len(lm.score(docs, model, counts).collect()) == len(texts)
    assert (model.unit > lm.FLOOR) == (pair_common > 0.001)
    repeated = 0 if model.unit <= lm.FLOOR else sum(n for n in Counter(p for t in texts for p in zip([None, *tokens(t)], tokens(t))).values() if n > 1)
    assert sum(len(r[0]) for r in kept[-1].select("_rare").collect()) < repeated + 50  # false hits
    assert repeated < 650
