import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from limnia.operators import merge, schema, summary
from limnia.plans import extraction
from limnia.sources import files, manifest, tables
from limnia.streaming.incremental import pixel_stream, stream_observations


def test_parquet_pattern_and_source_name(spark, tmp_path):
    root = str(tmp_path / "px")
    for name, v in (("keep_1", 1.0), ("keep_2", float("nan")), ("drop_3", 3.0)):
        spark.createDataFrame([(v,)], "v double").coalesce(1).write.parquet(f"{root}/{name}.dir")
    df = tables.read_parquet(spark, root, pattern="part-*.parquet", recursive=True, source_column="src")
    assert sorted(str(r["v"]) for r in df.collect()) == ["1.0", "3.0", "None"]
    assert all(r["src"].startswith("part-") for r in df.collect())
    assert tables.optional(tables.read_parquet, spark, f"{root}/nothing") is None
    assert tables.optional(tables.read_parquet, spark, f"{root}/keep_1.dir").count() == 1


def test_empty_results_are_not_written(spark, tmp_path):
    empty = spark.createDataFrame([], "v double")
    assert not tables.write_parquet(empty, str(tmp_path / "deep" / "er"), unless_empty=empty)
    assert not (tmp_path / "deep").exists()
    assert tables.write_parquet(empty.unionAll(spark.createDataFrame([(1.0,)], "v double")), str(tmp_path / "deep" / "er"))
    assert not tables.write_csv(empty, str(tmp_path / "c"), unless_empty=empty)


def test_geojson_polygons_and_reference_system(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 0]]
    rows = [("a", json.dumps({"type": "Polygon", "coordinates": [square]})),
            ("b", json.dumps({"type": "MultiPolygon", "coordinates": [[square], [square, square]]}))]
    out = tables.polygons_from_geojson(spark.createDataFrame(rows, "lake_id string, geometry string"))
    got = {(r["lake_id"], r["part"]): len(r["rings"]) for r in out.collect()}
    assert got == {("a", 0): 1, ("b", 0): 1, ("b", 1): 2}
    assert out.first()["rings"][0][1]["x"] == 4.0
    path = str(tmp_path / "poly")
    assert tables.write_polygons(out.withColumn("srid", F.lit(4326)), path)
    assert tables.read_polygons(spark, path).count() == 3
    with pytest.raises(schema.SchemaError):
        tables.write_polygons(out, path + "2")
    with pytest.raises(PySparkException, match="reference system"):
        schema.check_srid(out.withColumn("srid", F.lit(None).cast("int"))).count()


def test_raster_checks(spark):
    px = spark.createDataFrame([(0, 0, 1.0), (0, 9, 1.0)], "y int, x int, CI_cyano double")
    with pytest.raises(schema.SchemaError):
        schema.check_raster(px, "CI_cyano")
    grid = spark.createDataFrame([(0, 0, 1.0, 1.0)], "y int, x int, lon double, lat double")
    with pytest.raises(PySparkException, match="position"):
        schema.check_raster(px.join(grid, ["y", "x"], "left"), "CI_cyano").count()


def test_file_signatures(spark, tmp_path):
    (tmp_path / "a.nc").write_bytes(b"\x89HDF\r\n\x1a\n1234")
    (tmp_path / "b.nc").write_bytes(b"CDF\x01xxxx")
    (tmp_path / "c.nc").write_bytes(b"<html>")
    (tmp_path / "d.nc").write_bytes(b"")
    (tmp_path / "e.txt").write_bytes(b"CDF")
    got = {r["src"]: r["is_array_file"] for r in files.file_signatures(spark, str(tmp_path), "*.nc").collect()}
    assert got == {"a.nc": True, "b.nc": True, "c.nc": False}  # empty files are not listed
    assert files._open_head(str(tmp_path / "gone")) == b""


def test_reader_status(spark):
    px = spark.createDataFrame([("a", 1), ("b", 2)], "src string, v int")
    status = spark.createDataFrame([("a", "primary"), ("b", None)], "src string, engine string")
    assert [tuple(r) for r in files.readable_only(px, status).collect()] == [("a", 1, "primary")]
    with pytest.raises(PySparkException, match="unreadable"):
        files.readable_only(px, status, strict=True).count()


def test_manifests(spark):
    daily = manifest.expected_daily(manifest.daily_span(spark, 2024, "ALASKA")).orderBy("date").collect()
    assert len(daily) == 366 and daily[59]["src"] == "S3M_OLCI_EFRNT.20240229.L3m.DAY.ILW_ALASKA.V5.all.ILW_AK.300m.nc"
    y1, y2 = manifest.year_range("2023-2024")
    spans = spark.createDataFrame([("CONUS", y1, y2, 2, 3)], "region string, year1 int, year2 int, month1 int, month2 int")
    got = [r["src"] for r in manifest.expected_monthly(spans, "S3B").orderBy("date").collect()]
    assert len(got) == 4 and got[2] == "S3B_OLCI_EFRNT.20240201_20240229.L3m.MO.ILW_CONUS.V5.all.CONUS.300m.nc"
    assert manifest.year_range("2024") == (2024, 2024)
    have = spark.createDataFrame([("a", 5), ("b", 0)], "src string, length long")
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "src string")
    remote = spark.createDataFrame([("b",)], "src string")
    assert {r["src"]: r["action"] for r in files.audit_files(want, have, remote).collect()} == {"a": "skip", "b": "get", "c": "miss"}
    assert {r["src"] for r in files.missing_files(want, have).collect()} == {"b", "c"}
    urls = spark.createDataFrame([("https://h/d/daymet_v4_daily_na_tmin_2024.nc?t=1",), ("https://h/m/daymet_v4_prcp_monttl_hi_2024.tif",)], "url string")
    got = [tuple(r)[1:] for r in manifest.url_manifest(urls).collect()]
    assert got == [("daymet_v4_daily_na_tmin_2024.nc", "tmin", "na", None, 2024, "nc"),
                   ("daymet_v4_prcp_monttl_hi_2024.tif", "prcp", "hi", "monttl", 2024, "tif")]


def test_schema_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("x", "X", "x")
    assert schema.drop_repeated_columns(df).columns == ["x", "X"]
    assert schema.resolve_time_column(spark.createDataFrame([(1, 2)], "lake int, my_timestamp int")) == "my_timestamp"
    with pytest.raises(schema.SchemaError):
        schema.resolve_time_column(spark.range(1))
    assert schema.with_lake_name(spark.range(1).withColumnRenamed("id", "lake_id")).first()["lake_name"] == "0"
    odd = spark.createDataFrame([(1, 2, 3.0)], "rows int, cols int, v double")
    assert schema.normalise_coordinates(odd, ["time", "rows", "cols"]).columns == ["y", "x", "v"]
    assert schema.normalise_coordinates(odd.toDF("latitude", "longitude", "v")).columns == ["lat", "lon", "v"]
    with pytest.raises(schema.SchemaError):
        schema.normalise_coordinates(odd)
    counts = spark.createDataFrame([(0, 0, 5), (0, None, 6)], "n_valid int, valid_count int, n int")
    assert [r["n_valid"] for r in schema.choose_count_column(counts).collect()] == [5, 6]
    assert schema.provenance(spark.range(1), engine="t").first()["engine"] == "t"
    with pytest.raises(schema.SchemaError, match="Huron"):
        schema.in_listed_order(spark.createDataFrame([("Erie",)], "n string"), "n", ["Erie", "Huron"])


def test_outer_merge_matches_pivot_and_null_keys(spark):
    rows = [("a", "x", 1.0), ("a", "y", 2.0), (None, "x", 3.0), (None, "y", 4.0), ("b", "y", 5.0)]
    long = spark.createDataFrame(rows, "k string, var string, value double")
    parts = [long.where(F.col("var") == v).select("k", F.col("value").alias(v)) for v in ("x", "y")]
    key = lambda r: str(r["k"])
    merged = sorted(merge.outer_merge(parts, ["k"]).collect(), key=key)
    assert merged == sorted(merge.outer_pivot(long, ["k"], ["x", "y"]).collect(), key=key)
    assert len(merged) == 3


def test_union_first_wins(spark):
    a = spark.createDataFrame([(1, "a"), (2, "a")], "id int, src string")
    b = spark.createDataFrame([(2, "b"), (3, "b")], "id int, src string")
    assert {r["id"]: r["src"] for r in merge.union_first_wins([a, b], "id").collect()} == {1: "a", 2: "a", 3: "b"}


def test_profile_and_audit(spark):
    df = spark.createDataFrame([(1.0, "x", dt.date(1970, 1, 2)), (3.0, "y", None), (None, "x", dt.date(1970, 1, 4))],
                               "v double, s string, d date")
    p = {r["column"]: r for r in summary.profile(df).collect()}
    assert (p["v"]["count"], p["v"]["mean"], p["v"]["p50"], p["v"]["max"]) == (2, 2.0, 2.0, 3.0)
    assert (p["s"]["unique"], p["s"]["top"], p["s"]["freq"], p["s"]["mean"]) == (2, "x", 2, None)
    assert (p["d"]["min"], p["d"]["p75"]) == (1.0, 2.5)
    rows = spark.createDataFrame([("f", "e", "a", dt.date(2024, 1, 1)), ("f", "e", "b", dt.date(2024, 1, 3)), ("g", "e", "a", None)],
                                 "src string, engine string, lake_id string, date date")
    a = {r["src"]: r for r in summary.file_audit(rows).collect()}
    assert a["f"]["date_text"] == "2024-01-01→2024-01-03 (n=2)" and a["f"]["n_lakes"] == 2
    assert a["g"]["date_text"] == "NA"


BOXES = "lake_id string, minx double, miny double, maxx double, maxy double"


def pixels(spark, day):
    src = f"S3M_OLCI_EFRNT.202401{day:02d}.L3m.DAY.ILW_CONUS.V5.all.CONUS.300m.nc"
    return spark.createDataFrame([(src, 1.5, 1.5, 0.001 * day), (src, 1.6, 1.5, float("nan")), (src, 1.7, 1.5, 1e-5)],
                                 "src string, lon double, lat double, CI_cyano float")


def test_extraction_fails_without_label(spark):
    px = pixels(spark, 1).withColumn("src", F.lit("unnamed.nc"))
    boxes = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 2.0)], BOXES)
    with pytest.raises(PySparkException, match="no date"):
        extraction.daily_observations(px, boxes, px.select("src").distinct()).collect()


def test_stream_processes_each_file_once(spark, tmp_path):
    boxes = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 2.0), ("b", 5.0, 5.0, 6.0, 6.0)], BOXES)
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))

    def arrive(day):
        pixels(spark, day).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = pixel_stream(spark, src, pixels(spark, 1).schema)
        q = stream_observations(stream, boxes, out, ck)
        assert q.awaitTermination(120)
        return spark.read.parquet(out)

    arrive(1)
    arrive(2)
    assert run().count() == 4
    arrive(3)
    rows = run().orderBy("date", "lake_id").collect()
    assert [(r["date"].day, r["lake_id"], r["n_valid"]) for r in rows] == [
        (1, "a", 1), (1, "b", 0), (2, "a", 1), (2, "b", 0), (3, "a", 1), (3, "b", 0)]
    assert rows[4]["CI_mean"] == pytest.approx(0.003)
    arrive(2)  # more pixels of a source file whose statistics are out already
    with pytest.raises(Exception, match="earlier batch"):
        run()
