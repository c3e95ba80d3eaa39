import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from limnia.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(hashes, fanout):
    """Root, and for each leaf its (left, right) siblings upwards."""
    proofs = [[] for _ in hashes]
    at, level = list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for k, p in enumerate(proofs):
            run = at[k] // fanout * fanout
            p.append(("".join(level[run : at[k]]), "".join(level[at[k] + 1 : run + fanout])))
            at[k] //= fanout
        level = [digest("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return level[0], proofs


def plain_manifest(rows, fanout):
    """rows: (key, group, values ...); gives (key, leaf, subroot, root, proof) of each."""
    groups = defaultdict(list)
    for r in rows:
        groups["" if r[1] is None else "=" + r[1]].append((r[0], leaf_of(r)))
    names = sorted(groups, key=str.encode)
    made = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0], x[1]) if x[0] is not None else (False, 0, x[1]))
        made[g] = tree([h for _, h in groups[g]], fanout)
    root, over = tree([made[g][0] for g in names], fanout)
    out = []
    for g, above in zip(names, over, strict=True):
        for (key, h), proof in zip(groups[g], made[g][1], strict=True):
            out.append((key, h, made[g][0], root, tuple(proof + above)))
    return out


def rows_of(n_by_group):
    out = []
    for g, n in n_by_group.items():
        out += [(i * 7 % 1009, g, None if i % 5 == 0 else f"té{i}", i % 11) for i in range(n)]
    return out


CASES = [
    {"de": 1},
    {"de": 2, None: 1, "": 3},
    {"a": 16, "b": 17, "é": 257, None: 33, "Z": 255, "": 1},
    {f"g{i}": i % 4 + 1 for i in range(40)},
]


@pytest.mark.parametrize("fanout, levels", [(2, 4), (2, 1), (3, 2), (5, 1)])
def test_equals_plain_trees(spark, fanout, levels):
    for case in CASES[1:3] if (fanout, levels) != (2, 4) else CASES:
        rows = rows_of(case)
        docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, n_chars long").repartition(3)
        made = merkle.manifest(docs, docs.columns, "lang", "doc_id", keep=["doc_id"], fanout=fanout, levels=levels)
        got = made.withColumn("back", merkle.fold(F.col("_leaf"), F.col("_proof"))).collect()
        assert all(r["back"] == r["_root"] for r in got)
        have = Counter((r["doc_id"], r["_leaf"], r["_subroot"], r["_root"], tuple(tuple(s) for s in r["_proof"])) for r in got)
        assert have == Counter(plain_manifest(rows, fanout))


def test_nulls_repeated_rows_and_other_columns(spark):
    rows = [(1, "a", "x", 1)] * 37 + [(None, "a", None, None)] * 5 + [(None, "a", "", None), (2, None, "long " * 100_000, 3), (2, None, "other", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, n_chars long")
    wide = docs.selectExpr("*", "'q' AS slot", "1 AS digest", "'r' AS root", "2 AS `left`")
    made = merkle.manifest(wide, docs.columns, "lang", "doc_id", keep=["doc_id", "root"])
    got = Counter((r["doc_id"], r["_leaf"], r["_subroot"], r["_root"], tuple(tuple(s) for s in r["_proof"])) for r in made.collect())
    assert got == Counter(plain_manifest(rows, 2))
    assert {r["root"] for r in made.collect()} == {"r"}


def test_change_is_found(spark):
    docs = spark.createDataFrame(rows_of({"a": 50, "b": 9}), "doc_id long, lang string, text string, n_chars long")
    changed = merkle.leaf([F.col("doc_id"), F.col("lang"), F.col("text"), F.col("n_chars") + 1])
    made = merkle.manifest(docs.withColumn("_c", changed), docs.columns, "lang", "doc_id", keep=["doc_id", "_c"])
    assert made.filter(merkle.fold(F.col("_c"), F.col("_proof")) == F.col("_root")).count() == 0


def test_many_ranges(spark, monkeypatch):
    rows = rows_of({"a": 300, "b": 100})
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string, n_chars long")
    monkeypatch.setattr(merkle, "RANGE_ROWS", 20)
    made = merkle.manifest(docs, docs.columns, "lang", "doc_id", keep=["doc_id"])
    got = Counter((r["doc_id"], r["_leaf"], r["_subroot"], r["_root"], tuple(tuple(s) for s in r["_proof"])) for r in made.collect())
    assert got == Counter(plain_manifest(rows, 2))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert merkle.manifest(docs, docs.columns, "lang", "doc_id", keep=["doc_id"]).collect() == []
