import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from limnia.functions import cleaning, flags, geometry, text, timelabel


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()], F.lit(1).alias("one"))
    return df.select(expr.alias("x")).first()["x"]


def column(spark, schema, rows, expr):
    return [r["x"] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expr.alias("x")).collect()]


NAN, INF = float("nan"), float("inf")


def test_only_null_means_missing(spark):
    assert column(spark, "v double", [1.0, NAN, INF, -INF, None], cleaning.finite("v")) == [1.0, None, None, None, None]
    assert column(spark, "v string", ["2.5", "junk", None, "NaN"], cleaning.to_number("v")) == [2.5, None, None, None]


def test_index_bounds_are_single_precision(spark):
    v = F.col("v").cast("float")
    out = column(spark, "v double", [0.1, 0.2, 5e-5, 6e-5, NAN, None], cleaning.clean_index(v, 0.0, 0.1))
    assert [x is not None for x in out] == [True, False, False, True, False, False]
    # bounds that are not finite are skipped; a high lower bound raises the background level
    assert column(spark, "v double", [9.0], cleaning.clean_index(v, NAN, None)) == [9.0]
    assert column(spark, "v double", [0.5, 0.51], cleaning.clean_index(v, 0.5))[0] is None


def test_time_label_order(spark):
    daily = "/d/S3M_OLCI_EFRNT.20240102.L3m.DAY.ILW_CONUS.V5.all.CONUS.300m.nc"
    monthly = "/d/S3B_OLCI_EFRNT.20240201_20240229.L3m.MO.ILW_CONUS.V5.all.CONUS.300m.nc"
    rows = [
        (daily, "2024-05-06T01:00:00Z", None, None, "daily"), (daily, None, "2024-03-01", "2024-03-09", "daily"),
        (daily, None, "2024-03-01", None, "daily"), (daily, None, "junk", "2024-03-09", "daily"),
        (monthly, None, "2024-01-01", "2024-01-02", "monthly"), (monthly, None, None, None, "monthly"),
        ("/d/other.nc", None, None, None, "daily"),
    ]
    df = spark.createDataFrame(rows, "src string, t string, a string, b string, p string")
    cols = [F.col(c) for c in "tab"]
    label = F.when(F.col("p") == "daily", timelabel.time_label("src", "daily", *cols)).otherwise(
        timelabel.time_label("src", "monthly", *cols))
    got = [r["x"] for r in df.select(label.cast("timestamp_ntz").alias("x")).collect()]
    t = dt.datetime
    assert got == [t(2024, 5, 6, 1), t(2024, 3, 1), t(2024, 1, 2), t(2024, 1, 2), t(2024, 1, 1, 12), t(2024, 2, 15), None]


def test_lenient_parse(spark):
    texts = ["2024-01-16 16:53:28.5+00:00", "2024-01-02", "01/05/2024", "20240107", "junk", None, "2024-01-02T03:00:00+02:00"]
    got = column(spark, "s string", texts, timelabel.parse_lenient("s").cast("timestamp_ntz"))
    t = dt.datetime
    assert got == [t(2024, 1, 16, 16, 53, 28, 500000), t(2024, 1, 2), t(2024, 1, 5), t(2024, 1, 7), None, None, t(2024, 1, 2, 1)]


def test_period_start(spark):
    ts = F.lit("2024-05-16 10:30:00").cast("timestamp_ntz")
    for code, want in (("D", (5, 16)), ("W", (5, 13)), ("MS", (5, 1)), ("M", (5, 1)), ("Q", (4, 1)), ("Y", (1, 1))):
        assert one(spark, timelabel.period_start(ts, code)) == dt.date(2024, *want)
    with pytest.raises(ValueError):
        timelabel.period_start(ts, "nope")


def test_flags(spark):
    assert column(spark, "n double", [None, 10.0, 60.0], flags.below_flag("n", 50.0)) == [0, 1, 0]
    assert column(spark, "r double", [None, 0.05, 0.1], flags.low_ratio_flag("r", 0.1)) == [None, 1, 0]
    assert column(spark, "a double", [45000.0, 225000.0], flags.expected_pixels("a")) == [0, 2]  # half to even
    assert one(spark, flags.coverage_ratio(F.lit(5), F.lit(0))) is None
    v = F.lit(1.0)
    null = F.lit(None).cast("int")
    assert one(spark, flags.row_is_valid([null, F.lit(0)], v)) == 1
    assert one(spark, flags.row_is_valid([null, F.lit(1)], v)) == 0
    assert one(spark, flags.row_is_valid([null, null], v)) == 1
    assert one(spark, flags.row_is_valid([null, null], F.lit(NAN))) == 0
    assert one(spark, flags.shade_height(F.lit(1.7), F.lit(10.0))) == 2.0
    assert one(spark, flags.shade_height(F.lit(None).cast("double"), F.lit(10.0))) == 0.0


def test_names(spark):
    rows = ["Erie", "ERIE", "Lake Erie", "Erie.", None]
    assert column(spark, "n string", rows, text.is_any("n", ["Erie", "Huron"])) == [True, True, False, False, False]
    assert column(spark, "n string", rows, text.mentions_any("n", ["erie"])) == [True, True, True, True, False]
    assert column(spark, "n string", ["United states, Canada", None], text.contains_text("n", "United States")) == [True, False]
    assert one(spark, text.display_label(F.lit("GL-1"), F.lit(None).cast("string"))) == "GL-1 - "
    assert one(spark, text.url_basename(F.lit("https://a/b/c.nc?x=1"))) == "c.nc"


def test_albers_textbook_point(spark):
    # worked example on the 1866 Clarke ellipsoid: 35 N 75 W
    a, b = 6378206.4, 6356583.8
    x, y = geometry.albers(F.lit(-75.0), F.lit(35.0), a=a, f=(a - b) / a)
    row = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert row["x"] == pytest.approx(1885472.7, abs=0.1)
    assert row["y"] == pytest.approx(1535925.0, abs=0.1)


MIXED = [
    "1/5/2024", "January 5, 2024", "2024-01-05 6:30 PM", "05-Jan-2024", "Jan 5 2024", "20240105T063000", "20240105 06:30",
    "2024/01/05 06:30", "2024.01.05", "1/5/2024 6:30", "Jan 5, 2024 06:30", "13/1/2024", "5 January 2024 1:02:03 am", "junk", None,
]


def test_mixed_dates_match_pandas(spark):
    got = column(spark, "s string", MIXED, timelabel.parse_lenient("s").cast("timestamp_ntz"))
    want = pd.to_datetime(pd.Series(MIXED), format="mixed", errors="coerce")
    assert [None if x is None else pd.Timestamp(x) for x in got] == [None if pd.isna(x) else x for x in want]


def pandas_reads(text):
    """As ``format="mixed"`` reads one text, in UTC."""
    got = pd.to_datetime(pd.Series([text]), format="mixed", errors="coerce", utc=True)[0]
    return None if pd.isna(got) else got.tz_localize(None).to_pydatetime()


SHAPES = [
    "Fri Jan 5 2024", "Jan 2024", "20240105063000", "1/5/24", "Friday, January 5, 2024", "01-05-2024", "2024", "202401", "240105",
    "202401050630", "Jan 5", "2024 Jan 5", "2024-Jan-05", "5-Jan-24", "Jan-05-24", "05Jan2024", "5th Jan 2024",
    "January 5th, 2024 at 6:30 pm", "6:30 PM Jan 5 2024", "Jan 5 2024 6pm", "31/12/99", "1.5.2024", "2024/1", "1/2024",
    "01/05/2024 06:30+02:00", "2024-01-05 06:30:00 EST", "20240105T0630Z", "Sept 5 2024", "2024Q1", "2024-W05", "24-01-13", "99/1/5",
    "2024-13-01", "2024.01.05 06.30", "12:30 AM 1/5/2024", "1/5/2024 24:00", "Thu, 05 Jan 2024 06:30:00 -0500", "Fri Jan  5 06:30:00 2024",
    "5 2024 Jan", "Jan 2024 5", "hello 2024", "5 of January 2024", "2024-01-05 06", "2024-1-5 6:3", "2024 1 5", "30/2/2024", "",
]


def test_date_shapes_match_pandas(spark):
    got = column(spark, "s string", SHAPES, timelabel.parse_lenient("s").cast("timestamp_ntz"))
    assert dict(zip(SHAPES, got, strict=True)) == {s: pandas_reads(s) for s in SHAPES}


def test_generated_dates_match_pandas(spark):
    rnd = random.Random(1)
    months = "Jan January feb MARCH Apr May Jun June Jul July Aug Sep Sept September Oct November Dec December".split()
    days = "Mon Monday Tue Wednesday Thu Fri Friday Sat Sunday".split()
    texts = []
    for _ in range(600):
        y, m, d, name = rnd.randrange(1980, 2030), rnd.randrange(1, 13), rnd.randrange(1, 29), rnd.choice(months)
        z = lambda v: rnd.choice([str(v), f"{v:02d}"])
        short = rnd.choice([str(y), f"{y % 100:02d}"])
        date = rnd.choice([
            f"{z(m)}/{z(d)}/{short}", f"{z(d)}/{z(m)}/{short}", f"{name} {z(d)}, {short}", f"{z(d)} {name} {short}", f"{z(d)}-{name}-{short}",
            f"{rnd.choice(days)}, {name} {z(d)}, {short}", f"{z(m)}-{z(d)}-{short}", f"{z(d)}.{z(m)}.{short}", f"{y}-{z(m)}-{z(d)}",
            f"{y}/{z(m)}/{z(d)}", f"{y}{m:02d}{d:02d}", f"{y}-{name}-{z(d)}", f"{d}th of {name} {y}",
        ])
        h, mi, s = rnd.randrange(24), rnd.randrange(60), rnd.randrange(60)
        time = rnd.choice([
            "", "", f" {h:02d}:{mi:02d}", f" {h}:{mi:02d}:{s:02d}", f" {h:02d}:{mi:02d}:{s:02d}.{rnd.randrange(10**6):06d}",
            f" {h % 12 + 1}:{mi:02d} {rnd.choice(['AM', 'pm'])}", f" {h % 12 + 1}{rnd.choice([' am', 'PM'])}", f"T{h:02d}:{mi:02d}:{s:02d}Z",
            f" {h:02d}:{mi:02d}+0{rnd.randrange(9)}:30", f" {h:02d}:{mi:02d}:{s:02d} UTC", f" {h:02d}:{mi:02d} -0{rnd.randrange(1, 9)}00",
        ])
        texts.append(time.strip() + " " + date if time.startswith(" ") and rnd.random() < 0.2 else date + time)
    got = column(spark, "s string", texts, timelabel.parse_lenient("s").cast("timestamp_ntz"))
    wrong = [(t, g, w) for t, g, w in zip(texts, got, map(pandas_reads, texts), strict=True) if g != w]
    assert wrong == []


def test_bounds_in_the_pixels_own_precision(spark):
    values = [5e-5, 5.0000001e-5, 0.1, 0.2, 0.20000000001]
    assert column(spark, "s double", values, cleaning.clean_index("s")) == [None, *values[1:]]
    # the background test is strict and its threshold is the larger of the two lower limits
    assert column(spark, "s double", values, cleaning.clean_index("s", 0.1, 0.2)) == [None, None, None, 0.2, None]
    kept = column(spark, "s float", [5e-5, 0.1, 0.2, 0.3], cleaning.clean_index("s", 0.1, 0.2))
    assert [x is not None for x in kept] == [False, False, True, False]
