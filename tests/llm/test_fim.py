import hashlib
import random
import re

import pytest

from limnia.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_version(doc_id, text, rate=50, spm=80):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = [m.group() for m in UNIT.finditer(text)]
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("seed", range(20))
def test_ends_equal_findall_whatever_the_window(seed):
    rnd = random.Random(seed)
    for _ in range(200):
        text = "".join(rnd.choice("ab \n\t\x0b\x85\xa0é😀\x00<P>") for _ in range(rnd.randrange(0, 40)))
        want = [m.end() for m in UNIT.finditer(text)]
        assert fim.unit_ends(text).tolist() == want
        assert fim.unit_ends(text, rnd.randrange(1, 9)).tolist() == want


def test_windows_never_cut_a_unit():
    text = "x" * 1000 + " " * 1000 + "y" + " " * 50
    assert fim.unit_ends(text, 10).tolist() == [1000, 2001, 2051]
    assert list(fim.windows(text, 10)) == [(0, 1000), (1000, 2001), (2001, 2051)]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    parts = ["a", "bé", "😀", " ", "  ", "\n", "\t", "\r\n", "<", ">", "P>", "<S", "M", "ccc", "\xa0", "\x00"]
    out = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 60))), "n") for i in range(800)]
    out += [(900 + i, t, "x") for i, t in enumerate([None, "", " ", "\n\n", "word", "<P>", "a <M> b", "<S", " lead", "trail "])]
    out += [(None, "one two three four", None), (None, None, None), (3, out[3][1], "n"), (3, "another text of id three", "n")]
    return [*out, (5000, "wörd " * 400_000, "long"), (5001, "<P" * 200_000, "long"), (5002, " " * 300_000, "long")]


def test_equals_plain_version_and_restores(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, _form string")
    made = fim.transform(docs)
    assert made.columns == ["doc_id", "text", *fim.NEW]
    got = made.withColumn("back", fim.restore(made["_output"], made["_form"])).collect()
    assert len(got) == len(rows)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    want = sorted(((d, t, *plain_version(d, t)) for d, t, _ in rows), key=key)
    assert sorted(((r["doc_id"], r["text"], *(r[c] for c in fim.NEW)) for r in got), key=key) == want
    assert all(r["back"] == (r["text"] or "") for r in got)
    assert {r["_form"] for r in got} == {"plain", "psm", "spm"}


def test_shares_and_other_columns(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('some words of ', id) AS text", "id AS n", "'f' AS form")
    made = fim.transform(docs, seed=7, rate=100, spm=0)
    assert made.columns == ["doc_id", "text", "n", "form", *fim.NEW]
    assert {r[0] for r in made.select("_form").distinct().collect()} == {"psm"}
    assert made.filter("n <> doc_id OR form <> 'f'").count() == 0
    assert fim.transform(docs, seed=7).exceptAll(fim.transform(docs.repartition(3), seed=7)).count() == 0
    forms = dict(fim.transform(docs, seed=7).groupBy("_form").count().collect())
    assert 1350 < forms["plain"] < 1650 and 200 < forms["psm"] < 400


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert fim.transform(docs).collect() == []
