import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from limnia.llm import packing
from limnia.llm.tokens import Encoder


def reference_ids(encoder, text):
    return [*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_encoder_equals_tokenizer():
    e = Encoder.of()
    rnd = random.Random(5)
    odd = ["", None, "It's we're 'sample ''s don't I'LL 've 'l r", "Ärger Ÿ Œuvre ſ ŉ", "a<|endoftext|>b", "x × y ÷ İ ı", "日本 ² Ⅷ", "12 345...?!'s '"]
    made = ["".join(rnd.choice("ab'stmdrvel  \n.,!?01ÄéßŸ<|") for _ in range(rnd.randrange(40))) for _ in range(500)]
    ids, at = e.encode(pa.array(odd + made, pa.string()))
    for i, t in enumerate(odd + made):
        assert ids[at[i] : at[i + 1]].tolist() == reference_ids(e, t)


def test_first_fit_decreasing_equals_plain_search():
    rnd = np.random.default_rng(1)
    sizes = rnd.integers(1, 100, 300)
    free, want = [], {}
    for i in np.argsort(-sizes, kind="stable"):
        b = next((k for k, x in enumerate(free) if x >= sizes[i]), None)
        if b is None:
            free.append(100)
            b = len(free) - 1
        free[b] -= sizes[i]
        want[i] = b
    assert packing.first_fit_decreasing(sizes, 100).tolist() == [want[i] for i in range(len(sizes))]


@pytest.mark.parametrize("sizes", [[], [5], [100], [60, 60, 60], [1] * 37, [99, 98, 3, 40, 41]])
def test_layout_covers_every_id_once(sizes):
    laid = packing.lay_out(np.array(sizes, dtype=np.int64), 100, 4)
    seen = sorted((p, x) for s in laid for p, a, b in s for x in range(a, b))
    assert seen == [(p, x) for p, n in enumerate(sizes) for x in range(n)]
    for s in laid:
        n = sum(b - a for _, a, b in s)
        assert n <= 100 and (n >= 96 or n & (n - 1) == 0)


def test_pack_round_trip(spark):
    rnd = random.Random(2)
    words = ["stone", "river", "Ärger", "it's", "42", "..."]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 50, 700, 9000]))), "x", 1) for i in range(60)]
    rows += [(7, "twice", "x", 1), (7, "twice", "x", 1), (None, "no id", "x", 1), (61, None, None, None), (62, "", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, start int")
    got = packing.pack(docs).collect()
    e = Encoder.of()
    by_doc, by_seq = {}, {}
    for r in got:
        assert zlib.crc32(r["ids"]) >= 0 and len(r["ids"]) == 4 * r["length"]
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, t in {(r[0], r[1]) for r in rows}:
        ids = reference_ids(e, t)
        copies = sum((i, t) == (r[0], r[1]) for r in rows)
        parts = sorted(by_doc[i, len(ids)])
        assert sorted(x for _, p in parts for x in p) == sorted(ids * copies)
        if copies == 1:
            assert [x for _, p in parts for x in p] == ids
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= packing.LENGTH
    assert packing.padding_share(packing.pack(docs)) < 0.03


def test_pack_empty(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_text_with_more_words_than_the_cache(monkeypatch):
    from limnia.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_WORDS", 50)
    e = Encoder(tokens.DEFAULT)
    rnd = random.Random(9)
    texts = ["stone and river", " ".join("".join(rnd.choice("abcde") for _ in range(6)) for _ in range(400)), None, "it's stone 42"]
    for _ in range(2):
        ids, at = e.encode(pa.array(texts, pa.string()))
        assert [ids[at[i] : at[i + 1]].tolist() for i in range(4)] == [reference_ids(e, t) for t in texts]
        ids, at = e.encode(pa.array(texts[3:], pa.string()))
        assert ids.tolist() == reference_ids(e, texts[3]) and len(e.keys) <= 50
