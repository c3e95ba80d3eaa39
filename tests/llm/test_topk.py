import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnia.llm import topk


@pytest.fixture(autouse=True)
def small_blocks(monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(topk, "DIMENSIONS", 3)


def plain(rows, k):
    good = [
        (i, [math.floor(256 * x) for x in v])
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, x in good:
        if q % 10 == 0:
            scored = [(-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q and len(x) == len(y)]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, q int, v string")
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def test_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (5, 8))
    rows = [(i, (centres[i % 5] + rng.normal(0, 0.2, 8)).round(2).tolist()) for i in range(300)]
    rows += [(400 + i, [0.5] * 8) for i in range(40)]  # equal vectors: ties
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 7), (903, [float("nan")] * 8), (904, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(910, [1.0, 2.0]), (911, [2.0, 1.0]), (1000, [0.0] * 8)]
    assert run(spark, rows) == plain(rows, 5)


def test_large_numbers_and_few_rows(spark):
    rows = [(i, [2e5 * (i + 1), 6e5, -3e5 * i]) for i in range(12)]
    assert run(spark, rows) == plain(rows, 5)
    assert run(spark, rows[:3]) == plain(rows[:3], 5)
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == []
    huge = [(i, [1e9 * i]) for i in range(1, 12)]
    assert [(r[2], r[3]) for r in run(spark, huge, 2)] == [(1, (1 << 63) - 1), (2, (1 << 63) - 1)]


def test_bounds_drop_candidates():
    rng = np.random.default_rng(1)
    v = rng.integers(-30, 30, (5000, 12)) * np.array([20, 20, 20, 8, 8, 8, 2, 2, 2, 1, 1, 1])
    got = list(topk.search_block(np.array([0]), v[:1], np.arange(5000), v, 5))
    scores = v @ v[0]
    want = sorted((-int(s), i) for i, s in enumerate(scores) if i)[:5]
    assert [(-s, i) for _, i, s in got] == want
