import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from limnia.operators import resample, series


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def make(spark, values, key="s"):
    rows = [(key, day(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, date date, v double")


def values(df, col="v"):
    return [r[col] for r in df.orderBy("date").collect()]


N = None


@pytest.mark.parametrize("given,limit,want", [
    ([1] + [N] * 7 + [9], 3, [1, 2, 3, 4, N, 6, 7, 8, 9]),
    ([1] + [N] * 5 + [7], 3, [1, 2, 3, 4, 5, 6, 7]),
    ([1, N, N, N, 5], 1, [1, 2, N, 4, 5]),
    ([N] * 4 + [5, 6] + [N] * 5, 3, [N, 5, 5, 5, 5, 6, 6, 6, 6, N, N]),
    ([N, N, N], 3, [N, N, N]),
])
def test_interpolation_cases(spark, given, limit, want):
    assert values(series.interpolate_short_gaps(make(spark, given), ["k"], ["v"], limit)) == want


@pytest.mark.parametrize("limit", [1, 3])
def test_interpolation_matches_pandas(spark, limit):
    rng = np.random.default_rng(limit)
    frames = []
    for k in range(40):
        v = np.where(rng.random(60) < 0.6, np.nan, rng.normal(size=60))
        frames.append(pd.DataFrame({"k": str(k), "date": [day(i) for i in range(60)], "v": v}))
    pdf = pd.concat(frames, ignore_index=True)
    df = spark.createDataFrame(pdf).withColumns({"date": F.to_date("date"), "v": F.nanvl("v", F.lit(None))})
    got = series.interpolate_short_gaps(df, ["k"], ["v"], limit).toPandas().sort_values(["k", "date"])
    want = pdf.groupby("k")["v"].transform(lambda s: s.interpolate(limit=limit, limit_direction="both"))
    pdf = pdf.assign(v=want).sort_values(["k", "date"])
    np.testing.assert_allclose(got["v"].astype(float), pdf["v"], rtol=1e-12)


def test_fill_calendar_equals_spine_join(spark):
    df = spark.createDataFrame(
        [("a", day(0), 1.0), ("a", day(4), 2.0), ("b", day(2), 3.0)], "k string, date date, v double"
    )
    filled = series.fill_calendar(df, ["k"], "D")
    spine = series.calendar_spine(df, ["k"], "D").join(df, ["k", "date"], "left")
    key = lambda r: (r["k"], r["date"])
    assert sorted(filled.collect(), key=key) == sorted(spine.select("k", "date", "v").collect(), key=key)
    months = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 4, 1), 2.0)], df.schema)
    assert values(series.fill_calendar(months, ["k"], "MS")) == [1.0, N, N, 2.0]


def test_first_row_per_period_is_earliest_then_tie(spark):
    t = dt.datetime
    df = spark.createDataFrame(
        [("a", t(2024, 1, 5, 9), "z", 1.0), ("a", t(2024, 1, 5, 8), "y", 2.0), ("a", t(2024, 1, 5, 8), "x", 3.0),
         ("a", t(2024, 2, 1), None, 4.0)],
        "k string, date timestamp_ntz, src string, v double",
    )
    got = {r["date"]: r["v"] for r in series.first_per_period(df, ["k"], "D", tie=["src"]).collect()}
    assert got == {dt.date(2024, 1, 5): 3.0, dt.date(2024, 2, 1): 4.0}
    assert series.first_per_period(df, ["k"], "MS", tie=["src"]).count() == 2


def test_clip_keeps_missing_and_all_missing(spark):
    df = make(spark, [1, 2, 3, N, 1000]).unionByName(make(spark, [N, N], "none"))
    for out in (series.clip_calendar_series(df, ["k"], ["v"], 0.25, 0.75),
                series.clip_quantiles(df, ["k"], ["v"], 0.25, 0.75)):
        s = pd.Series([1, 2, 3, np.nan, 1000])
        want = [N if np.isnan(x) else x for x in s.clip(s.quantile(0.25), s.quantile(0.75))]
        assert values(out.where("k = 's'")) == want
        assert values(out.where("k = 'none'")) == [N, N]


@pytest.mark.parametrize("block", [4096, 8])
def test_centred_mean_matches_pandas(spark, monkeypatch, block):
    monkeypatch.setattr(series, "_BLOCK", block)  # small blocks: every seam is crossed
    rng = np.random.default_rng(5)
    pdf = pd.concat([
        pd.DataFrame({"k": str(k), "date": [day(int(i)) for i in np.sort(rng.choice(400, 90, replace=False))],
                      "v": np.where(rng.random(90) < 0.4, np.nan, rng.normal(size=90))})
        for k in range(8)
    ], ignore_index=True)
    df = spark.createDataFrame(pdf).withColumns({"date": F.to_date("date"), "v": F.nanvl("v", F.lit(None))})
    got = series.centred_mean(df, ["k"], {"m": "v"}).toPandas().sort_values(["k", "date"])
    assert len(got) == len(pdf)
    want = pdf.groupby("k")["v"].transform(lambda s: s.rolling(7, center=True, min_periods=3).mean())
    np.testing.assert_allclose(got["m"].astype(float), pdf.assign(m=want).sort_values(["k", "date"])["m"], rtol=1e-9)


def test_centred_mean_case(spark):
    got = values(series.centred_mean(make(spark, [1, N, N, N, N, 6, 7]), ["k"], {"m": "v"}), "m")
    assert got[:3] == [N] * 3 and got[3] == pytest.approx(14 / 3) and got[4:] == [N] * 3


def climate(spark, rows):
    return spark.createDataFrame(rows, "lake_id string, date date, v double")


def test_week_ends_on_monday(spark):
    out = resample.weekly_to_monday(climate(spark, [("a", day(i), float(i)) for i in range(10)]), ["v"])
    assert [(r["date"].day, r["v"]) for r in out.orderBy("date").collect()] == [(1, 0.0), (8, 4.0), (15, 8.5)]


def test_seven_day_bins_start_at_each_lakes_first_day(spark):
    rows = [("a", day(i), 1.0) for i in range(8)] + [("b", day(2 + i), 1.0) for i in range(8)]
    rows += [("c", day(0), 1.0), ("c", day(15), 5.0)]
    out = resample.weekly_from_first_day(climate(spark, rows), ["v"]).orderBy("lake_id", "date").collect()
    assert [(r["lake_id"], r["date"].day, r["v"]) for r in out] == [
        ("a", 1, 1.0), ("a", 8, 1.0), ("b", 3, 1.0), ("b", 10, 1.0), ("c", 1, 1.0), ("c", 8, None), ("c", 15, 5.0)]


def test_empty_month_is_kept(spark):
    rows = [("a", dt.date(2024, 1, 9), 1.0), ("a", dt.date(2024, 3, 9), 3.0)]
    out = resample.monthly(climate(spark, rows), ["v"]).orderBy("date").collect()
    assert [(r["date"].month, r["v"]) for r in out] == [(1, 1.0), (2, None), (3, 3.0)]


def test_trailing_window_excludes_day_28(spark):
    rows = [("a", day(0), 1.0), ("a", day(27), 2.0), ("a", day(28), 3.0)]
    out = resample.trailing_mean(climate(spark, rows), ["v"]).orderBy("date").collect()
    assert [r["v"] for r in out] == [1.0, 1.5, 2.5]


def test_trailing_mean_and_bins_match_pandas_over_years(spark):
    rng = np.random.default_rng(9)
    pdf = pd.concat([
        pd.DataFrame({"lake_id": str(k), "date": pd.to_datetime("2010-03-04") + pd.to_timedelta(np.sort(rng.choice(5000, 900, replace=False)), "D"),
                      "v": np.where(rng.random(900) < 0.3, np.nan, rng.normal(size=900))})
        for k in range(3)
    ], ignore_index=True)
    df = spark.createDataFrame(pdf).withColumns({"date": F.to_date("date"), "v": F.nanvl("v", F.lit(None))})
    g = pdf.set_index("date").groupby("lake_id")["v"]
    for got, want in (
        (resample.trailing_mean(df, ["v"]), g.rolling("28D").mean()),
        (resample.weekly_from_first_day(df, ["v"]), g.resample("7D").mean()),
        (resample.weekly_to_monday(df, ["v"]), g.resample("W-MON").mean()),
        (resample.monthly(df, ["v"]), g.resample("MS").mean()),
    ):
        got = got.toPandas().sort_values(["lake_id", "date"])
        want = want.reset_index().sort_values(["lake_id", "date"])
        assert [d.isoformat() for d in got["date"]] == [d.date().isoformat() for d in want["date"]]
        np.testing.assert_allclose(got["v"].astype(float), want["v"], rtol=1e-9, atol=1e-12)
