import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from limnia.operators import quantiles as q
from limnia.operators.quantiles import attach, group_stats

SPEC = {"p90": ("v", 0.9), "p05": ("v", 0.05), "med": ("v", 0.5), "w999": ("w", 0.999), "lo": ("v", 0.001), "top": ("w", 1.0)}


def expected(pdf, keys):
    def one(g):
        out = {o: g[c].quantile(p) for o, (c, p) in SPEC.items()}
        return pd.Series({**out, "nv": g["v"].count(), "nw": g["w"].count(), "mv": g["v"].mean()})

    return pdf.groupby(keys, dropna=False)[["v", "w"]].apply(one).reset_index()


def frame(seed, n):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "k": rng.choice(["a", "b", None, "c"], n, p=[0.6, 0.2, 0.1, 0.1]),
        # one tight cluster inside a single cell, one wide two-signed spread, many repeats of 0
        "v": rng.permutation(np.concatenate([
            rng.lognormal(0, 1e-6, n // 3), rng.normal(0, 1e3, n // 3), np.zeros(n - 2 * (n // 3)),
        ])),
        "w": rng.integers(-3, 3, n).astype(float),
    })
    pdf.loc[rng.random(n) < 0.05, "v"] = np.nan
    pdf.loc[pdf.k == "c", "w"] = np.nan
    return pdf


def check(got, want):
    got, want = got.sort_values("k").reset_index(drop=True), want.sort_values("k").reset_index(drop=True)
    assert len(got) == len(want)
    for c in [*SPEC, "mv"]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-12, atol=1e-12, err_msg=c)
    for c in ("nv", "nw"):
        assert got[c].tolist() == want[c].astype(int).tolist()


@pytest.mark.parametrize("seed,splits", [(1, 65536), (2, 16)])
def test_groups_match_pandas(spark, monkeypatch, seed, splits):
    monkeypatch.setattr(q, "_SPLITS", splits)
    pdf = frame(seed, 6000)
    got = group_stats(spark.createDataFrame(pdf), ["k"], ["v", "w"], SPEC, {"nv": "v", "nw": "w"}, {"mv": "v"})
    check(got.toPandas(), expected(pdf, "k"))


def test_tight_range_with_one_outlier(spark):
    """Nearly all values in one cell and close together, the cell's other end far off."""
    rng = np.random.default_rng(4)
    v = np.append(1.0 + rng.permutation(20000) * 1e-12, 1.004)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    row = group_stats(df, [], ["v"], {"a": ("v", 0.25), "b": ("v", 0.9), "c": ("v", 0.99999)}).first()
    for name, p in (("a", 0.25), ("b", 0.9), ("c", 0.99999)):
        assert row[name] == pytest.approx(np.quantile(v, p), rel=1e-15)


def counting(spark, df):
    """The same rows, and how often a row was read."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), read


def test_input_is_read_once_unless_a_cell_is_crowded(spark):
    df, read = counting(spark, spark.range(3000).selectExpr("id % 3 AS k", "id / 7 AS v"))
    rows = {r["k"]: r["p"] for r in group_stats(df, ["k"], ["v"], {"p": ("v", 0.9)}, {"n": "v"}, {"m": "v"}).collect()}
    for k in range(3):
        assert rows[k] == pytest.approx(np.quantile(np.arange(k, 3000, 3) / 7, 0.9), rel=1e-12)
    assert read.value == 3000
    # all values in one cell: the rows are read again to tell them apart
    df, read = counting(spark, spark.range(20_000).selectExpr("id % 2 AS k", "1 + id * 1e-13 AS v"))
    probs = {"a": ("v", 0.1), "b": ("v", 0.5), "c": ("v", 0.999)}
    rows = {r["k"]: r for r in group_stats(df, ["k"], ["v"], probs).collect()}
    for k in range(2):
        want = np.quantile(1 + np.arange(k, 20_000, 2) * 1e-13, [0.1, 0.5, 0.999])
        assert [rows[k][c] for c in "abc"] == pytest.approx(list(want), abs=1e-15)
    assert read.value <= 3 * 20_000


def test_single_precision_and_no_keys(spark):
    rng = np.random.default_rng(3)
    v = rng.lognormal(-7, 1, 20000).astype("float32")
    df = spark.createDataFrame(pd.DataFrame({"v": v})).withColumn("v", F.col("v").cast("float"))
    row = group_stats(df, [], ["v"], {"p": ("v", 0.9)}, {"n": "v"}, {"m": "v"}).first()
    assert row["n"] == 20000
    assert row["p"] == pytest.approx(np.quantile(v.astype(float), 0.9), rel=1e-12)
    assert row["m"] == pytest.approx(v.astype(float).mean(), rel=1e-9)


def test_group_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan")), ("b", 2.0)], "k string, v double")
    rows = {r["k"]: r for r in group_stats(df, ["k"], ["v"], {"p": ("v", 0.9)}, {"n": "v"}, {"m": "v"}).collect()}
    assert (rows["a"]["p"], rows["a"]["n"], rows["a"]["m"]) == (None, 0, None)
    assert (rows["b"]["p"], rows["b"]["n"], rows["b"]["m"]) == (2.0, 1, 2.0)


def test_column_names_cannot_clash(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (2, 5.0)], "n long, v double").selectExpr("n AS cell", "v")
    rows = group_stats(df, ["cell"], ["v"], {"k": ("v", 0.5)}).collect()
    assert {r["cell"]: r["k"] for r in rows} == {1: 3.0, 2: 5.0}


def test_attach_without_keys_and_with_null_key(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 3.0)], "k string, v double")
    got = attach(df, group_stats(df, [], ["v"], {"mid": ("v", 0.5)}), []).collect()
    assert [r["mid"] for r in got] == [2.0, 2.0]
    got = attach(df, group_stats(df, ["k"], ["v"], {"mid": ("v", 0.5)}), ["k"]).collect()
    assert {r["k"]: r["mid"] for r in got} == {None: 1.0, "a": 3.0}
