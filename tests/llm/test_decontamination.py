import random
import re

import pytest

from limnia.llm import decontamination as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(doc, items, size):
    w, hit, names = words(doc), set(), set()
    for name, text in items:
        v = words(text)
        n = min(size, len(v))
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


def cases(seed, small):
    rnd = random.Random(seed)
    vocab = ["a", "B", "c", "É", "the", "of", "x9"][: 4 if small else 7]
    say = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, say(rnd.choice([0, 1 if small else 3, 2, 4, 5, 6, 9, 14]))) for i in range(6)] + [(6, None), (None, say(8)), (3, "z z z z z z")]
    docs = [(i, say(rnd.randrange(60))) for i in range(40)] + [(1, None), (1, ""), (None, "..."), (2, items[0][1]), (50, say(30000))]
    return items, docs


@pytest.mark.parametrize("seed,small", [(1, False), (2, True), (3, False)])
def test_scan_equals_plain(spark, seed, small):
    items, docs = cases(seed, small)
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    got = dec.scan(frame, bench, min_words=5).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3])
    have = sorted(((r["doc_id"], r["_n_words"], r["_n_hit"], sorted(r["_items"])) for r in got), key=key)
    assert have == sorted(((d, *plain(t, items, 5)) for d, t in docs), key=key)


def test_shards_agree(spark, monkeypatch):
    items, docs = cases(4, False)
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    one = dec.scan(frame, bench, 5).select("doc_id", "_n_hit", "_items", "_spans").collect()
    monkeypatch.setattr(dec, "SHARD_BYTES", 60)
    assert dec.scan(frame, bench, 5).select("doc_id", "_n_hit", "_items", "_spans").collect() == one


def test_cut_leaves_no_window(spark):
    items, docs = cases(5, False)
    clean = (200, "nothing of this is in any test item at all")
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame = spark.createDataFrame([*docs, clean], "doc_id long, text string")
    out = dec.decontaminate(frame, bench, 5, 1.0)
    assert out.columns == ["doc_id", "text"]
    rows = out.collect()
    assert len(rows) == len(docs) + 1 and clean in {tuple(r) for r in rows}
    assert all(plain(r["text"], items, 5)[1] == 0 for r in rows)
    assert {r["doc_id"] for r in dec.decontaminate(frame, bench, 5, 0.1).collect()} >= {200}


def test_empty_tables(spark):
    no_docs, no_items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id int, text string")
    one = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    assert dec.scan(no_docs, no_items).collect() == []
    assert dec.scan(one, no_items).first()["_n_hit"] == 0


def test_repeated_items_are_gathered_once(spark, monkeypatch):
    monkeypatch.setattr(dec, "Matcher", lambda pairs, n: [item for item, _ in pairs])
    monkeypatch.setattr(dec, "SHARD_BYTES", 200)
    rows = [(1, "which river runs through the old town")] * 300 + [(i, f"grey mill number {i}") for i in range(2, 20)] + [(None, None)] * 50
    gathered = list(dec._shards(spark.createDataFrame(rows, "item_id long, text string"), 5))
    assert sorted(x for part in gathered for x in part) == sorted(["", *map(str, range(1, 20))])
    assert len(gathered) <= 5
