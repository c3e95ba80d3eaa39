"""The whole pipeline, path to path, on a small invented region."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from limnia.plans import jobs
from limnia.sources import tables
from limnia.sources.tables import RINGS

RAW = f"Hylak_id long, Lake_name string, Country string, part long, srid int, rings {RINGS.simpleString()}"


def ring(x, y, r):
    return [[(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("region"))
    spark.createDataFrame([
        (1, "Erie", "United States of America", 1, 4326, ring(-81.0, 42.0, 0.4)),
        (2, "Huron", "Canada", 2, 4326, ring(-82.0, 45.0, 0.4)),
        (3, "Como", "Italy", 3, 4326, ring(9.0, 46.0, 0.4)),
    ], RAW).write.parquet(f"{d}/raw")
    # a 0.1 degree grid around both lakes, 40 days; lake two has no pixels on day 5
    grid = spark.range(60 * 60).select(
        (F.col("id") / 60).cast("int").alias("y"), (F.col("id") % 60).cast("int").alias("x"))
    grid = grid.withColumns({"lon": -84.95 + F.col("x") / 10.0, "lat": 40.05 + F.col("y") / 10.0})
    grid.write.parquet(f"{d}/grid")
    days = spark.range(40).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    px = grid.join(days, on=[grid.y >= 0]).withColumn(
        "src", F.concat(F.lit("S3M_OLCI_EFRNT."), F.date_format("d", "yyyyMMdd"), F.lit(".L3m.DAY.ILW_CONUS.V5.all.CONUS.300m.nc")))
    v = F.when((F.day("d") == 5) & (F.col("lat") > 44), F.lit(None)).otherwise((F.col("x") + F.day("d")) * 1e-5 + 1e-4)
    px.select("src", "y", "x", "lon", "lat", v.cast("float").alias("CI_cyano")).write.parquet(f"{d}/pixels")
    px.select("src").distinct().select(
        "src", F.when(F.col("src").contains("20240107"), F.lit(None)).otherwise("primary").alias("engine"),
        F.create_map(F.lit("valid_max"), F.lit("0.00075"), F.lit("time_coverage_start"), F.lit("")).alias("attrs"),
    ).write.parquet(f"{d}/files")
    cube = px.select("y", "x", F.col("d").alias("time"), F.explode(F.array(F.lit("tmin"), F.lit("tmax"))).alias("var"), "lat")
    cube.select("y", "x", "time", "var", (F.col("lat") + F.day("time")).alias("value")).write.parquet(f"{d}/cube")
    return d


def test_pipeline(spark, stored):
    d = stored
    jobs.select_lakes(spark, f"{d}/raw", f"{d}/cand", f"{d}/lakes", order=("Erie", "Huron"), step_m=200.0)
    lakes = spark.read.parquet(f"{d}/lakes")
    assert sorted((r["lake_id"], r["lake_name"]) for r in lakes.collect()) == [("GL-1", "Erie"), ("GL-2", "Huron")]

    assert jobs.extract_daily(spark, f"{d}/pixels", f"{d}/lakes", f"{d}/daily", files=f"{d}/files")
    obs = {(r["lake_id"], r["date"].date()): r for r in spark.read.parquet(f"{d}/daily").collect()}
    assert len(obs) == 2 * 39 and ("GL-1", dt.date(2024, 1, 7)) not in obs  # unreadable file left out
    first = obs["GL-1", dt.date(2024, 1, 1)]
    assert (first["n_valid"], first["engine"], first["product"]) == (64, "primary", "daily")
    assert obs["GL-2", dt.date(2024, 1, 5)]["n_valid"] == 0 and obs["GL-2", dt.date(2024, 1, 5)]["CI_mean"] is None
    # the file's own upper bound removes the brightest columns late in January
    assert obs["GL-1", dt.date(2024, 1, 31)]["n_valid"] < 64

    # a path-to-path report of the files, and the unreadable one left out of the region too
    assert jobs.extract_daily(spark, f"{d}/pixels", f"{d}/lakes", f"{d}/daily2", files=f"{d}/files", audit=f"{d}/audit")
    assert spark.read.option("header", True).csv(f"{d}/audit").count() == 39
    assert jobs.extract_region(spark, f"{d}/pixels", f"{d}/region_readers", "daily", files=f"{d}/files", valid_max=0.005)
    region = spark.read.option("header", True).csv(f"{d}/region_readers")
    assert region.count() == 39 and {r["engine"] for r in region.select("engine").distinct().collect()} == {"primary"}

    assert jobs.extract_region(spark, f"{d}/pixels", f"{d}/region", "daily", valid_max=0.005)
    assert jobs.check_region(spark, f"{d}/region", "D", f"{d}/qc", "region_daily")
    assert not jobs.check_region(spark, f"{d}/nothing", "D", f"{d}/qc", "x")
    clean = spark.read.option("header", True).csv(f"{d}/qc/region_daily_clean")
    assert clean.count() == 40 and "qc_low_coverage" in clean.columns
    jobs.regional_feeds(spark, f"{d}/qc/region_daily_clean", f"{d}/feeds/region")
    assert spark.read.parquet(f"{d}/feeds/region").where("CI_mean_7 IS NOT NULL").count() == 40

    assert jobs.check_lakes(spark, f"{d}/daily", f"{d}/lakes", f"{d}/qc", "lakes_daily", pix_res_m=10000.0, min_abs_pix=10)
    assert not jobs.check_lakes(spark, f"{d}/none", f"{d}/lakes", f"{d}/qc", "x")
    qc = spark.read.parquet(f"{d}/qc/lakes_daily_clean")
    assert qc.count() == 78 and {r["lake_name"] for r in qc.collect()} == {"Erie", "Huron"}
    assert qc.where("qc_is_valid = 0").count() >= 1
    assert spark.read.option("header", True).csv(f"{d}/qc/lakes_daily_counts").count() == 2
    paths = jobs.chart_feeds(spark, f"{d}/qc/lakes_daily_clean", f"{d}/feeds", names=("Erie",))
    matrix = spark.read.parquet(paths[2])
    assert matrix.count() == 2 and len(matrix.columns) == 40 and {r["label"] for r in matrix.collect()} == {"GL-1 - Erie", "GL-2 - Huron"}
    assert spark.read.parquet(paths[1]).select("lake_id").distinct().count() == 1

    jobs.lake_climate(spark, f"{d}/cube", f"{d}/grid", f"{d}/lakes", f"{d}/climate", variables=("tmin", "tmax"))
    clim = spark.read.parquet(f"{d}/climate")
    assert clim.count() == 80
    assert clim.where("lake_id = 'GL-1' AND day(date) = 1 AND month(date) = 1").first()["tmin"] == pytest.approx(43.0)
    paths = jobs.resample_climate(spark, f"{d}/climate", f"{d}/resampled", ("tmin", "tmax"))
    assert [spark.read.parquet(p).count() for p in paths] == [12, 14, 80, 4]

    jobs.merge_features(spark, f"{d}/qc/lakes_daily_clean", f"{d}/climate", f"{d}/features", variables=("tmin", "tmax"))
    out = spark.read.parquet(f"{d}/features")
    assert out.count() == qc.where("qc_is_valid = 1").count() and out.where("tmin IS NULL").count() == 0


def test_missing_pixels_warn(spark, stored):
    with pytest.warns(UserWarning, match="no daily pixels"):
        assert not jobs.extract_daily(spark, f"{stored}/nowhere", f"{stored}/raw", f"{stored}/x")


def test_inset_reaches_every_job(spark, tmp_path):
    """The study lakes' inset shrinks boxes, expected pixels and climate masks."""
    d = str(tmp_path)
    spark.createDataFrame([(1, "Erie", "United States", 1, 4326, ring(-81.0, 42.0, 0.4))], RAW).write.parquet(f"{d}/raw")
    grid = spark.range(100 * 100).select((F.col("id") / 100).cast("int").alias("y"), (F.col("id") % 100).cast("int").alias("x"))
    grid = grid.withColumns({"lon": -81.495 + F.col("x") / 100.0, "lat": 41.505 + F.col("y") / 100.0})
    grid.write.parquet(f"{d}/grid")
    src = F.lit("S3M_OLCI_EFRNT.20240101.L3m.DAY.ILW_CONUS.V5.all.CONUS.300m.nc").alias("src")
    grid.select(src, "y", "x", "lon", "lat", F.lit(1e-3).cast("float").alias("CI_cyano")).write.parquet(f"{d}/pixels")
    edge = F.least(0.4 - F.abs(F.col("lon") + 81.0), 0.4 - F.abs(F.col("lat") - 42.0))  # degrees to the shore
    grid.select("y", "x", F.lit("2024-01-01").alias("time"), F.lit("tmin").alias("var"), (edge < 0.05).cast("double").alias("value")
                ).write.parquet(f"{d}/cube")
    seen = {}
    for inset in (0.0, 8000.0):
        jobs.select_lakes(spark, f"{d}/raw", f"{d}/cand", f"{d}/lakes", order=("Erie",), inset_m=inset, step_m=200.0)
        jobs.extract_daily(spark, f"{d}/pixels", f"{d}/lakes", f"{d}/daily")
        jobs.check_lakes(spark, f"{d}/daily", f"{d}/lakes", f"{d}/qc", "e", pix_res_m=500.0)
        jobs.lake_climate(spark, f"{d}/cube", f"{d}/grid", f"{d}/lakes", f"{d}/clim", variables=("tmin",))
        row = spark.read.parquet(f"{d}/qc/e_clean").first()
        seen[inset] = row["n_valid"], row["expected_pixels_geom"], spark.read.parquet(f"{d}/clim").first()["tmin"]
    assert seen[0.0][0] == 80 * 80
    # 8 km are 0.072 degrees of latitude and 0.097 of longitude there
    assert seen[8000.0][0] == pytest.approx((80 - 19.4) * (80 - 14.4), rel=0.04)
    assert seen[8000.0][1] / seen[0.0][1] == pytest.approx(0.62, abs=0.03)
    assert seen[0.0][2] > 0.1 and seen[8000.0][2] == 0.0


def test_only_the_lakes_tiles_are_opened(spark, tmp_path):
    px = spark.range(40 * 40).selectExpr(
        "cast(id div 40 AS int) AS y", "cast(id % 40 AS int) AS x", "-100D + (id % 40) AS lon", "30D + (id div 40) * 0.5D AS lat",
        "cast(0.001 AS float) AS CI_cyano").withColumn("src", F.concat(
            F.lit("S3M_OLCI_EFRNT.2024010"), (F.col("x") % 3 + 1).cast("string"), F.lit(".L3m.DAY.ILW_CONUS.V5.all.CONUS.300m.nc")))
    px.drop("tile").write.parquet(f"{tmp_path}/plain")
    tables.write_pixels(px, f"{tmp_path}/tiled")
    px.select("src").distinct().write.parquet(f"{tmp_path}/files")
    spark.createDataFrame([("L", "L", 0, 4326, ring(-82.0, 43.0, 2.4)), ("M", "M", 0, 4326, ring(-70.0, 35.0, 1.0))],
                          RAW.replace("Hylak_id long", "lake_id string").replace("Lake_name", "lake_name").replace("Country string, ", "")
                          ).write.parquet(f"{tmp_path}/lakes")
    boxes = spark.createDataFrame([("L", -84.4, 40.6, -79.6, 45.4), ("M", -71.0, 34.0, -69.0, 36.0)],
                                  "lake_id string, minx double, miny double, maxx double, maxy double")
    tiled = tables.read_pixels(spark, f"{tmp_path}/tiled", "CI_cyano")
    near = tables.near_boxes(tiled, boxes)
    assert "tile" not in near.columns and len(tiled.inputFiles()) > 40
    # nothing of a box is lost
    inside = "(lon BETWEEN -84.4 AND -79.6 AND lat BETWEEN 40.6 AND 45.4) OR (lon BETWEEN -71 AND -69 AND lat BETWEEN 34 AND 36)"
    assert near.where(inside).count() == px.where(inside).count() > 0
    # files of other tiles are not opened: they may be junk
    tables.write_pixels(px, f"{tmp_path}/spoilt")
    schema = spark.read.parquet(f"{tmp_path}/spoilt").schema
    opened = {Path(r[0]).parent.name for r in near.select(F.col("_metadata.file_path")).distinct().collect()}
    for folder in Path(f"{tmp_path}/spoilt").glob("tile=*"):
        if folder.name not in opened:
            for f in folder.glob("*.parquet"):
                f.write_bytes(b"junk")
                (folder / f".{f.name}.crc").unlink(missing_ok=True)
    spoilt = spark.read.schema(schema).parquet(f"{tmp_path}/spoilt")
    assert tables.near_boxes(spoilt, boxes).where(inside).count() == px.where(inside).count() and len(opened) < 15
    with pytest.raises(Exception, match="(?i)parquet"):
        spoilt.agg(F.sum("lon")).collect()
    results = []
    for kind in ("plain", "tiled"):
        assert jobs.extract_daily(spark, f"{tmp_path}/{kind}", f"{tmp_path}/lakes", f"{tmp_path}/out_{kind}", files=f"{tmp_path}/files")
        results.append(sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out_{kind}").select("lake_id", "date", "CI_mean", "n_valid").collect()))
    assert results[0] == results[1] and len(results[0]) == 6
