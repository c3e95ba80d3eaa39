import random
import re
from collections import defaultdict

import numpy as np

from limnia.llm import lines
from limnia.llm.lines import CuckooFilter, LineIndex


def test_cuckoo_insert_delete():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, 20000))
    made = CuckooFilter.build(keys)
    assert made.contains(keys).all()
    other = rng.integers(-(1 << 62), 1 << 62, 20000)
    assert made.contains(other).mean() < 0.01
    again = CuckooFilter.from_bytes(made.to_bytes())
    again.delete(keys[:10000])
    assert again.contains(keys[10000:]).all() and again.contains(keys[:10000]).mean() < 0.01
    assert CuckooFilter.build(keys[:0]).contains(keys).sum() == 0


def key_of(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def plain(rows, min_docs=5, min_chars=40):
    seen = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key_of(x)) >= min_chars:
                seen[key_of(x)].add(d)
    keep = {k: max((d for d in v if d is not None), default=None) for k, v in seen.items() if len(v) >= min_docs}
    return sorted(
        (d is None, d or 0, "\n".join(x for x in (t or "").split("\n") if key_of(x) not in keep or keep[key_of(x)] == d))
        for d, t in rows
    )


def sample(seed, n, shift=0):
    rnd = random.Random(seed)
    pool = [" Éa boilerplate LINE number %d that many documents share, é \t" % i for i in range(12)]
    pool += ["x" * 39, "y" * 40, "É" * 40, "é" * 40, "", "\t ", "own"]
    rows = [(shift + i, "\n".join([rnd.choice(pool) for _ in range(rnd.randrange(8))] + ["only here %d" % i] * 2)) for i in range(n)]
    return rows


def got(index, spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, row int, k1 string")
    out = index.clean(docs)
    assert out.columns == ["doc_id", "text", "row", "k1", "_n_lines", "_dropped"]
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_clean_equals_plain(spark):
    rows = sample(1, 60) + [(100, None), (101, ""), (102, "\n"), (103, "a\n"), (3, "y" * 40), (3, "y" * 40), (None, "y" * 40 + "\nx"), (104, "w " * 40000)]
    index = LineIndex(spark)
    index.insert(frame(spark, rows))
    assert got(index, spark, rows) == plain(rows)


def test_insert_then_delete(spark):
    first, more = sample(2, 30), sample(3, 30, shift=1000)
    index = LineIndex(spark, shards=3)
    index.insert(frame(spark, first))
    before = got(index, spark, first)
    index.insert(frame(spark, more))
    assert got(index, spark, first + more) == plain(first + more)
    index.delete(frame(spark, more))
    assert got(index, spark, first) == before == plain(first)
    index.delete(frame(spark, first))
    assert index.repeated().count() == 0


def test_empty_table(spark):
    index = LineIndex(spark)
    index.insert(frame(spark, []))
    assert got(index, spark, []) == []


def test_shards_follow_the_references(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_REFERENCES", 20)
    first, more = sample(5, 25), sample(6, 25, shift=1000)
    index = LineIndex(spark)
    index.insert(frame(spark, first))
    few = index.shards
    index.insert(frame(spark, more))
    assert 1 < few < index.shards and index.filters().count() > 1
    assert got(index, spark, first + more) == plain(first + more)
