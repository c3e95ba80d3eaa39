import random

import numpy as np
import pyarrow as pa
import pytest

from limnia.llm import language
from limnia.llm.bytewords import raw

SAY = {
    "en": "the cat sat on the mat and then the dog went out with this thing",
    "de": "der hund und die katze sitzen auf einem teppich nicht weit von der tür",
    "fr": "le chat est sur la table avec une souris et les chiens dans la rue",
}


def plain_grams(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).encode()
    solid = [97 <= b <= 122 or b >= 128 for b in low]
    kept = [b if s else 32 for i, (b, s) in enumerate(zip(low, solid)) if s or (i + 1 < len(low) and solid[i + 1])]
    return [tuple(kept[i : i + 3]) for i in range(len(kept) - 2)]


def test_grams_equal_plain():
    texts = ["", "a", "The  cat, sat!", "é9é", None, "  x y", "tail ", "1 2 3", "Ärger"]
    codes, owners = language.gram_buckets(*raw(pa.array(texts, pa.string())))
    seen = {}
    for i, t in enumerate(texts):
        grams = plain_grams(t or "")
        mine = codes[owners == i].tolist()
        assert len(mine) == len(grams)
        for g, c in zip(grams, mine):
            assert seen.setdefault(g, c) == c


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, SAY[x] + f" {i}", x, i) for i in range(60) for x in [("en", "de", "fr")[i % 3]]]
    rows += [(100, None, "en", 0), (101, "", "en", 0), (102, "12 ... !", "de", 0), (103, "y", None, 0), (104, SAY["de"] * 2000, None, 0)]
    rows += [(None, SAY["fr"], None, 0), (1, SAY["en"], None, 0), (105, "²", None, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _row int")


def test_predict(docs):
    model = language.train(docs)
    assert model.languages == ["de", "en", "fr"]
    out = language.predict(docs, model)
    assert out.columns == ["doc_id", "text", "lang", "_row", "_lang", "_score"]
    by = {(r["doc_id"], r["text"]): r for r in out.collect()}
    assert len(by) == docs.distinct().count()
    for (d, t), r in by.items():
        assert 0 <= r["_score"] <= 1
        if d in (100, 101, 102, 105):
            assert (r["_lang"], r["_score"]) == ("und", 0)
        elif d != 103:
            assert r["_lang"] == next(k for k, v in SAY.items() if v in t)
    assert by[103, "y"]["_lang"] in model.languages


def test_mixture_finds_both_and_drops_the_rest(docs):
    model = language.train(docs)
    share = model.mixture(*language.gram_counts(pa.array([SAY["en"] + " " + SAY["de"]]))[0])
    assert (share > 0.25).sum() == 2 and share[2] == 0
    assert np.isclose(share.sum(), 1)
    assert np.count_nonzero(model.mixture(*language.gram_counts(pa.array([SAY["fr"]]))[0])) == 1


def test_no_training(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.predict(docs, language.train(docs)).first()["_lang"] == "und"
    assert language.predict(docs.limit(0), language.train(docs.limit(0))).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_windows_count_the_same(seed):
    rnd = random.Random(seed)
    text = "".join(rnd.choice(["ab", "C", " ", "   ", "9", "é", "!", "x"]) for _ in range(rnd.randrange(1, 200)))
    at, n = language.gram_counts(pa.array([text]))[0]
    for window in (1, 2, 3, 7, 50):
        at2, n2 = language.gram_counts(pa.array([text]), window)[0]
        assert at.tolist() == at2.tolist() and n.tolist() == n2.tolist()


def plain_em(prob, codes, rounds):
    """Expectation-maximisation n-gram by n-gram."""
    share = [1 / prob.shape[1]] * prob.shape[1]
    for _ in range(rounds):
        parts = [0.0] * len(share)
        for c in codes:
            given = [s * p for s, p in zip(share, prob[c])]
            for k, g in enumerate(given):
                parts[k] += g / sum(given)
        new = [p / len(codes) for p in parts]
        moved = max(abs(x - y) for x, y in zip(new, share))
        share = new
        if moved < 1e-3:
            break
    return share, sum(np.log(sum(s * p for s, p in zip(share, prob[c]))) for c in codes)


def test_mixture_equals_plain_inference(docs):
    """All sets of languages by the plain algorithm: leave out the weakest as long as it pays."""
    model = language.train(docs)
    for text in (SAY["en"], SAY["en"] + " " + SAY["de"], SAY["fr"] + " hund", SAY["de"] * 3 + SAY["fr"], "der the le"):
        codes, _ = language.gram_buckets(*raw(pa.array([text])))
        prob = model.prob.astype(float) / model.prob[np.arange(language.BUCKETS)].max(axis=1, keepdims=True)
        chosen = [0, 1, 2]
        share, fit = plain_em(prob, codes, model.rounds)
        some = [k for k, s in zip(chosen, share) if s > model.least]
        if some != chosen:
            chosen = some
            share, fit = plain_em(prob[:, chosen], codes, model.rounds)
        cost = model.penalty * len(codes) + 0.5 * np.log(len(codes) + 1)
        while len(chosen) > 1:
            rest = [k for k in chosen if k != chosen[int(np.argmin(share))]]
            fewer, less = plain_em(prob[:, rest], codes, model.rounds)
            if less + cost < fit:
                break
            chosen, share, fit = rest, fewer, less
        want = np.zeros(3)
        want[chosen] = share
        assert np.allclose(model.mixture(*language.gram_counts(pa.array([text]))[0]), want, atol=1e-3)


def test_many_labels_and_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    rows = [(i, SAY["en"] * 3, "en") for i in range(5)] + [(10 + i, SAY["de"] * 2, "de") for i in range(5)] + [(20, SAY["fr"], "fr")]
    rows += [(100 + i, "x y", f"label{i:04}") for i in range(1000)] + [(5000, SAY["de"] * 150_000, "de")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    assert model.languages == ["de", "en", "fr"]
    got = {r["doc_id"]: r["_lang"] for r in language.predict(docs.filter("doc_id < 100 OR doc_id = 5000"), model).collect()}
    assert got == {**{i: "en" for i in range(5)}, **{10 + i: "de" for i in range(5)}, 20: "fr", 5000: "de"}
