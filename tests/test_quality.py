import datetime as dt

import pytest
from pyspark.sql import functions as F

from limnia.operators import summary
from limnia.plans import features, feeds
from limnia.plans.quality import lake_quality, regional_quality
from limnia.sources.tables import REGIONAL_SERIES, read_csv, write_csv

# One year of monthly regional statistics and their cleaned form.
# time, mean, p90, valid pixels
RAW = """2024-01-16 16:53:28.500000+00:00,0.0005912500200793147,0.00047210059710778296,2030281
2024-02-15 17:12:11.500000+00:00,0.0005385525873862207,0.0003508322697598487,2204191
2024-03-16 16:44:09+00:00,0.0004923066589981318,0.0001664242590777576,1810493
2024-04-16 04:52:02+00:00,0.0004956075572408736,0.0005399586516432464,2151149
2024-05-16 17:01:29+00:00,0.0005003781989216805,0.0008361166692338884,2586974
2024-06-16 05:09:24+00:00,0.0006396860117092729,0.0011957526439800858,2585257
2024-07-16 17:18:47+00:00,0.0009836354292929173,0.002619389444589615,2674750
2024-08-16 17:15:03+00:00,0.0013584751868620515,0.004255122970789671,2938216
2024-09-16 04:39:51.500000+00:00,0.001413924852386117,0.004380481317639351,3168086
2024-10-16 16:49:11+00:00,0.0011279929894953966,0.003454537596553564,3238675
2024-11-16 04:58:35+00:00,0.0008149228524416685,0.002150949789211154,3271899
2024-12-16 16:21:56+00:00,0.0006610566051676869,0.0012595354346558452,2421322"""
CLEAN = """0.0005912500200793,0.0004721005971077,2030281,0
0.0005385525873862,0.0003508322697598,2204191,0
0.0004923429688787696,0.0001684527471952031,1810493,1
0.0004956075572408,0.0005399586516432,2151149,0
0.0005003781989216,0.0008361166692338,2586974,0
0.0006396860117092,0.00119575264398,2585257,0
0.0009836354292929,0.0026193894445896,2674750,0
0.001358475186862,0.0042551229707896,2938216,0
0.001413314906065335,0.004379102375823953,3168086,0
0.0011279929894953,0.0034545375965535,3238675,0
0.0008149228524416,0.0021509497892111,3271899,0
0.0006610566051676,0.0012595354346558,2421322,0"""


def test_monthly_region_from_csv(spark, tmp_path):
    path = tmp_path / "monthly.csv"
    path.write_text("time,CI_mean,CI_p90,n_valid\n" + RAW + "\n")
    out = regional_quality(read_csv(spark, str(path), REGIONAL_SERIES), "MS").orderBy("date")
    assert out.columns == ["date", "time", "CI_mean", "CI_p90", "n_valid", "qc_low_coverage"]
    rows = out.collect()
    assert [r["date"] for r in rows] == [dt.date(2024, m, 1) for m in range(1, 13)]
    for r, line in zip(rows, CLEAN.splitlines()):
        mean, p90, n, low = line.split(",")
        assert r["CI_mean"] == pytest.approx(float(mean), abs=1e-12)
        assert r["CI_p90"] == pytest.approx(float(p90), abs=1e-12)
        assert (r["n_valid"], r["qc_low_coverage"]) == (int(n), int(low))
    s = summary.missing_summary(out, "monthly").first()
    assert tuple(s) == ("monthly", 12, 0, 0, 0)
    assert write_csv(out, str(tmp_path / "clean"))
    assert spark.read.option("header", True).csv(str(tmp_path / "clean")).count() == 12


def test_daily_gaps_are_filled_but_counts_are_not(spark):
    days = [1, 2, 6, 7, 15]
    df = spark.createDataFrame([(f"2024-01-{d:02d}", float(d), float(d), 100) for d in days],
                               "date string, CI_mean double, CI_p90 double, n_valid long")
    rows = regional_quality(df, "D").orderBy("date").collect()
    assert len(rows) == 15
    mean = [r["CI_mean"] for r in rows]
    assert mean[2:5] == [3.0, 4.0, 5.0] and mean[10] is None and mean[9] == pytest.approx(10.0)
    assert [r["n_valid"] for r in rows][2] is None and all(r["qc_low_coverage"] == 0 for r in rows)


def test_regional_table_without_counts_warns(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0, 1.0)], "date string, CI_mean double, CI_p90 double")
    with pytest.warns(UserWarning, match="n_valid"):
        out = regional_quality(df, "D")
    assert "qc_low_coverage" not in out.columns
    assert summary.missing_summary(out, "x").first()["n_missing_n_valid"] is None


EXPECTED = "lake_id string, area_m2 double, expected_pixels_geom long, lake_name string"


@pytest.fixture(scope="module")
def lakes(spark):
    return spark.createDataFrame([("GL-1", 9e7, 1000, "Erie"), ("GL-2", 9e6, 100, "Huron")], EXPECTED)


def test_lake_flags(spark, lakes):
    rows = [
        ("GL-1", "2024-01-01", 1.0, 1.0, 500), ("GL-1", "2024-01-02", 2.0, 2.0, 49), ("GL-1", "2024-01-03", 3.0, 3.0, 0),
        ("GL-1", "2024-01-04", None, None, None), ("GL-2", "2024-01-01", 5.0, 5.0, 60), ("GL-9", "2024-01-01", 6.0, 6.0, 80),
        ("GL-1", "bad date", 9.0, 9.0, 500),
    ]
    df = spark.createDataFrame(rows, "lake_id string, time string, CI_mean double, CI_p90 double, n_valid long")
    out = lake_quality(df, lakes)
    assert "time" not in out.columns and out.first()["product"] == "unknown"
    got = {(r["lake_id"], r["date"].day): r for r in out.collect()}
    assert len(got) == 6

    def flags(*key):
        r = got[key]
        return r["qc_low_cov_geom"], r["qc_low_cov_emp"], r["qc_tiny_abs_pix"], r["qc_is_valid"]

    assert flags("GL-1", 1) == (0, 0, 0, 1)
    assert flags("GL-1", 2) == (1, 1, 1, 0)
    assert flags("GL-1", 3) == (1, 1, 1, 0)
    assert flags("GL-1", 4) == (None, None, 0, 1)  # unknown counts raise no flag
    assert flags("GL-2", 1) == (0, 0, 0, 1)
    assert flags("GL-9", 1) == (None, 0, 0, 1)  # lake without geometry
    assert got["GL-1", 1]["empiric_n_valid_max"] == 500
    # clipped per lake: the largest value moves just below itself
    assert 2.99 < got["GL-1", 3]["CI_mean"] < 3.0 and got["GL-2", 1]["CI_mean"] == 5.0

    counts = {r["lake_id"]: tuple(r)[1:] for r in summary.lake_counts(out).collect()}
    assert counts["GL-1"] == (4, 3, 2, 2)
    s = {r["lake_id"]: r for r in summary.quality_summary(out).collect()}
    assert (s["GL-1"]["rows"], s["GL-1"]["rows_valid"], s["GL-1"]["frac_valid"], s["GL-1"]["lake_name"]) == (4, 2, 0.5, "Erie")
    assert s["GL-1"]["pct_valid_geom_med"] == pytest.approx(0.049)
    assert tuple(features.valid_counts(out).first()) == (6, 4)


def test_all_zero_counts_read_as_unknown(spark, lakes):
    df = spark.createDataFrame([("GL-1", "2024-01-01", 1.0, 1.0, 0)], "lake_id string, date string, CI_mean double, CI_p90 double, n_valid long")
    r = lake_quality(df, lakes).first()
    assert (r["n_valid"], r["pct_valid_geom"], r["qc_low_cov_geom"], r["qc_is_valid"]) == (None, None, None, 1)


def test_feature_alignment(spark):
    obs = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 2, 9, 30), 1, 0.1), ("a", dt.datetime(2024, 1, 3), 1, 0.2), ("a", dt.datetime(2024, 1, 4), 0, 0.3)],
        "lake_id string, date timestamp_ntz, qc_is_valid int, CI_mean double")
    clim = spark.createDataFrame([("a", dt.datetime(2024, 1, d, 12), float(d)) for d in (2, 3, 4)],
                                 "lake_id string, date timestamp_ntz, tmin double")

    def run(align, c=clim):
        return sorted(((r["date"].day, r["tmin"]) for r in features.daily_features(obs, c, ["tmin"], align).collect()))

    assert run("day") == [(2, 2.0), (3, 3.0)]
    assert run("exact") == [(2, None), (3, None)]
    midnight = clim.withColumn("date", F.to_date("date"))
    assert run("exact", midnight) == [(2, None), (3, 3.0)]
    month = spark.createDataFrame([("a", dt.date(2024, 1, 1), 7.0)], "lake_id string, date date, tmin double")
    assert {r["tmin"] for r in features.monthly_features(obs, month, ["tmin"]).collect()} == {7.0}
    assert features.valid_rows(obs.drop("qc_is_valid")).count() == 3


def test_feeds(spark, lakes):
    rows = [(k, f"2024-01-{d:02d}", v * d, v * d, 100 * d) for k, v in (("GL-2", 1.0), ("GL-1", 2.0)) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "lake_id string, date string, CI_mean double, CI_p90 double, n_valid long")
    q = lake_quality(df, lakes, min_abs_pix=150)
    daily = feeds.lake_daily_feed(q).collect()
    assert [r["lake_id"] for r in daily[:10]] == ["GL-1"] * 10 and daily[0]["title"] == "Erie"
    assert daily[5]["CI_mean_7"] == pytest.approx(12.0, rel=1e-2)
    facets = feeds.facet_feed(q).collect()  # Huron is listed before Erie
    assert [r["title"] for r in facets[::10]] == ["Huron", "Erie"]
    assert facets[-1]["coverage_height"] == pytest.approx(1.0 * 20 * 0.2, rel=1e-2)
    assert [r["lake_id"] for r in feeds.facet_feed(q, names=["nowhere"]).collect()[::10]] == ["GL-1", "GL-2"]
    monthly = feeds.lake_monthly_feed(q).collect()
    assert len(monthly) == 18 and monthly[0]["has_CI_mean"]  # one tiny day per lake dropped
    matrix = summary.pivot_dates(q, ["2024-01-01", "2024-01-02"]).collect()
    assert [tuple(r) for r in matrix] == [("GL-1", 0, 1), ("GL-2", 0, 1)]
    labels = {r["label"] for r in summary.validity_long(q).collect()}
    assert labels == {"GL-1 - Erie", "GL-2 - Huron"}
