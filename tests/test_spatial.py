import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnia.operators import spatial
from limnia.operators.schema import SchemaError
from limnia.operators.zonal import file_lake_rows, pixels_in_boxes, zonal_stats
from limnia.plans import catalogue
from limnia.sources.tables import RINGS

SCHEMA = f"lake_id string, lake_name string, part long, srid int, rings {RINGS.simpleString()}"
SQUARE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
HOLE = [(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0)]
ARROW = [(0.0, 0.0), (4.0, 0.0), (2.0, 1.0), (4.0, 4.0), (0.0, 4.0)]  # concave


def polygons(spark, *shapes, srid=4326):
    """shapes: (lake, part, [rings])"""
    return spark.createDataFrame([(k, k, p, srid, rings) for k, p, rings in shapes], SCHEMA)


def inside(spark, polys, pts, inset=0.0, band=1.0):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "pid long, px double, py double")
    parts = polys.select("lake_id", "part")
    cand = df.join(parts, on=[df.pid >= 0])
    out = spatial.points_inside(cand, spatial.edges(polys), ["pid"], band, inset)
    return {(r["pid"], r["lake_id"]) for r in out.collect()}


def test_boundary_is_outside(spark):
    pts = [(2.0, 2.0), (5.0, 1.0), (0.0, 2.0), (4.0, 2.0), (2.0, 0.0), (0.0, 0.0), (2.0, 4.0)]
    assert inside(spark, polygons(spark, ("a", 0, [SQUARE])), pts) == {(0, "a")}


def test_closed_ring_hole_and_concave(spark):
    pts = [(2.0, 2.0), (0.5, 0.5), (3.5, 2.0), (1.0, 2.0)]
    holed = polygons(spark, ("h", 0, [SQUARE + SQUARE[:1], HOLE]))
    assert inside(spark, holed, pts) == {(1, "h"), (2, "h")}
    assert inside(spark, polygons(spark, ("c", 0, [ARROW])), pts) == {(0, "c"), (1, "c"), (3, "c")}


def test_inset_is_distance_to_shore(spark):
    poly = polygons(spark, ("a", 0, [SQUARE]))
    assert inside(spark, poly, [(2.0, 2.0), (3.9, 2.0), (3.5, 3.5)], inset=0.2) == {(0, "a"), (2, "a")}
    holed = polygons(spark, ("h", 0, [SQUARE, HOLE]))
    assert inside(spark, holed, [(0.5, 2.0), (0.9, 2.0)], inset=0.2) == {(0, "h")}


def test_parts_count_once_and_bands_do_not_matter(spark):
    far = [(x + 10, y) for x, y in SQUARE]
    polys = polygons(spark, ("a", 0, [SQUARE]), ("a", 1, [far]), ("b", 2, [ARROW]))
    rng = np.random.default_rng(1)
    pts = [tuple(map(float, p)) for p in rng.uniform(-1, 15, size=(300, 2))]

    def brute(ring, x, y):
        hit = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                hit = not hit
        return hit

    want = {(i, "a") for i, p in enumerate(pts) if brute(SQUARE, *p) or brute(far, *p)}
    want |= {(i, "b") for i, p in enumerate(pts) if brute(ARROW, *p)}
    for band in (0.13, 1.0, 50.0):
        assert inside(spark, polys, pts, band=band) == want


def test_touching_parts_have_no_shore_between_them(spark):
    left, right = [(0.0, 0.0), (2.0, 0.0), (2.0, 4.0), (0.0, 4.0)], [(2.0, 4.0), (2.0, 0.0), (4.0, 0.0), (4.0, 4.0)]
    slanted = [(0.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(4.0, 4.0), (0.0, 0.0), (4.0, 0.0)]
    rng = np.random.default_rng(2)
    pts = [(2.0, 1.0), (2.0, 0.1), (2.0, 4.0), (1.95, 2.0), (3.0, 3.0), (0.3, 0.3)] + [tuple(map(float, p)) for p in rng.uniform(-1, 5, (200, 2))]
    one = polygons(spark, ("a", 0, [SQUARE]))
    for inset in (0.0, 0.5):
        want = inside(spark, one, pts, inset)
        for parts in ((left, right), slanted):
            two = polygons(spark, *[("a", i, [r]) for i, r in enumerate(parts)])
            assert inside(spark, two, pts, inset) == want


def test_box_of_the_inset(spark):
    ring = [(-90.0, 45.0), (-89.0, 45.0), (-89.0, 46.0), (-90.0, 46.0)]
    polys = polygons(spark, ("a", 0, [ring]))
    whole = spatial.lake_boxes(polys).first()
    assert tuple(whole)[1:] == (-90.0, 45.0, -89.0, 46.0)
    # stated lake by lake in the table
    inner = spatial.lake_boxes(polys.withColumn("inset_m", F.lit(5000.0)), step_m=250.0).first()
    lat, lon = 5000 / 111200, 5000 / (111300 * math.cos(math.radians(45.0)))
    assert inner["miny"] == pytest.approx(45 + lat, abs=0.006) and inner["maxy"] == pytest.approx(46 - lat, abs=0.006)
    assert inner["minx"] == pytest.approx(-90 + lon, abs=0.006) and inner["maxx"] == pytest.approx(-89 - lon, abs=0.006)


def test_projection_inverse(spark):
    from limnia.functions.geometry import albers, albers_inverse

    df = spark.createDataFrame([(-120.0, 25.0), (-96.0, 37.0), (-70.0, 49.0)], "lon double, lat double")
    back = albers_inverse(*albers(F.col("lon"), F.col("lat")))
    for r in df.select("lon", "lat", back[0].alias("x"), back[1].alias("y")).collect():
        # a centimetre: the series for the latitude ends there
        assert r["x"] == pytest.approx(r["lon"], abs=1e-7) and r["y"] == pytest.approx(r["lat"], abs=1e-7)


def test_bounds_area_and_box(spark):
    polys = polygons(spark, ("a", 0, [SQUARE, HOLE]), ("a", 1, [[(10.0, 0.0), (12.0, 0.0), (12.0, 1.0)]]))
    e = spatial.edges(polys)
    assert tuple(spatial.bounds(e).first())[1:] == (0.0, 0.0, 12.0, 4.0)
    assert spatial.area(e).first()["area_m2"] == 16 - 4 + 1

    def meets(*box):
        return spatial.intersects_box(polygons(spark, ("a", 0, [SQUARE, HOLE])), *box).count() == 1

    assert meets(3.5, 3.5, 9.0, 9.0) and meets(4.0, 4.0, 9.0, 9.0) and meets(-1.0, -1.0, 9.0, 9.0)
    assert meets(0.2, 0.2, 0.4, 0.4)  # box within the polygon
    assert not meets(1.5, 1.5, 2.5, 2.5)  # box within the hole
    assert not meets(5.0, 5.0, 6.0, 6.0)
    diamond = polygons(spark, ("d", 0, [[(2.0, 0.0), (4.0, 2.0), (2.0, 4.0), (0.0, 2.0)]]))
    assert spatial.intersects_box(diamond, 3.6, 3.6, 4.0, 4.0).count() == 0  # bounds overlap, shapes do not


def test_degree_square_area_and_expected_pixels(spark):
    ring = [(-90.0, 45.0), (-89.0, 45.0), (-89.0, 46.0), (-90.0, 46.0)]
    row = spatial.expected_pixel_table(polygons(spark, ("a", 0, [ring]))).first()
    # one degree square on the ellipsoid, with straight chords for the parallels
    want = 111.2 * 111.2 * math.cos(math.radians(45.5)) * 1e6
    assert row["area_m2"] == pytest.approx(want, rel=0.01)
    assert row["expected_pixels_geom"] == round(row["area_m2"] / 90000)
    shrunk = spatial.lake_area(polygons(spark, ("a", 0, [ring])), inset_m=5000.0, step_m=1000.0).first()["area_m2"]
    width, height = row["area_m2"] ** 0.5 * 0.84, row["area_m2"] ** 0.5 / 0.84
    assert shrunk == pytest.approx((width - 1e4) * (height - 1e4), rel=0.03)


def test_box_join_counts_overlaps_once_per_lake(spark):
    px = spark.createDataFrame([(0, 1.5, 1.5), (1, 3.0, 2.0), (2, 9.0, 9.0), (3, -0.5, 0.5)], "y int, lon double, lat double")
    boxes = spark.createDataFrame([("a", -1.0, 0.0, 3.0, 2.0), ("b", 1.0, 1.0, 4.0, 4.0)],
                                  "lake_id string, minx double, miny double, maxx double, maxy double")
    for cell in (0.4, 1.0, 100.0, None):
        got = {(r["y"], r["lake_id"]) for r in pixels_in_boxes(px, boxes, cell).collect()}
        assert got == {(0, "a"), (0, "b"), (1, "a"), (1, "b"), (3, "a")}


def test_many_small_lakes_in_one_degree_meet_few_pixels_each(spark):
    from limnia.operators.zonal import _cell_key, lake_cells

    # 10,000 ponds of 0.008 degrees, one lake of two degrees around them, one of a single point
    boxes = spark.range(10_000).selectExpr(
        "concat('p', id) AS lake_id", "(id % 100) / 100.0 + 0.001 AS minx", "(id div 100) / 100.0 + 0.001 AS miny",
        "(id % 100) / 100.0 + 0.009 AS maxx", "(id div 100) / 100.0 + 0.009 AS maxy",
    ).selectExpr("lake_id", *(f"cast({c} AS double) AS {c}" for c in ("minx", "miny", "maxx", "maxy")))
    boxes = boxes.union(spark.sql("SELECT 'big', -0.5D, -0.5D, 1.5D, 1.5D UNION ALL SELECT 'point', 0.505D, 0.505D, 0.505D, 0.505D"))
    cells = lake_cells(boxes)
    assert cells.groupBy("lake_id").count().agg(F.max("count")).first()[0] <= 25
    px = spark.range(200 * 200).selectExpr("id", "(id % 200) / 200.0D AS lon", "(id div 200) / 200.0D AS lat").union(
        spark.sql("SELECT -1L, 0.505D, 0.505D"))
    # what an equi-join on level and cell lets through, before the exact test
    looked_up = px.crossJoin(cells.select("level", "side").distinct()).select(
        "id", _cell_key(F.col("level"), *(F.floor(F.col(c) / F.col("side")).cast("bigint") for c in ("lon", "lat"))).alias("cell"))
    met = looked_up.join(cells, "cell").groupBy("id").count().agg(F.max("count")).first()[0]
    assert met <= 12
    got = pixels_in_boxes(px, boxes)
    want = px.join(boxes, (px.lon >= boxes.minx) & (px.lon <= boxes.maxx) & (px.lat >= boxes.miny) & (px.lat <= boxes.maxy)).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_every_file_lists_every_lake(spark):
    px = spark.createDataFrame([("f1", 1.5, 1.5, 0.002), ("f1", 1.6, 1.5, 0.004), ("f2", 50.0, 50.0, 0.1)],
                               "src string, lon double, lat double, v double")
    boxes = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 2.0), ("b", 8.0, 8.0, 9.0, 9.0)],
                                  "lake_id string, minx double, miny double, maxx double, maxy double")
    got = {(r["src"], r["lake_id"]): (r["CI_mean"], r["CI_p90"], r["n_valid"])
           for r in zonal_stats(px, boxes, "v", ["src"]).collect()}
    assert set(got) == {("f1", "a"), ("f1", "b"), ("f2", "a"), ("f2", "b")}
    assert got["f1", "a"] == (pytest.approx(0.003), pytest.approx(0.0038), 2)
    assert got["f2", "b"] == (None, None, 0)
    assert zonal_stats(px, boxes, "v", ["src"], keep_empty=False).count() == 1
    files = spark.range(70).selectExpr("cast(id as string) AS src")
    lakes = spark.range(90).selectExpr("cast(id as string) AS lake_id")
    assert file_lake_rows(files, lakes).distinct().count() == 6300


def catalogue_rows(spark):
    def at(x, y, r=0.3):
        return [[(x - r, y - r), (x + r, y - r), (x + r, y + r), (x - r, y + r)]]

    rows = [
        (1, "Erie", "United States of America", 1, 4326, at(-120.0, 30.0)),  # by country
        (2, "Erie", "Canada", 2, 4326, at(-80.0, 45.0)),  # by box
        (3, "Erie", "Canada", 3, 4326, at(-60.0, 60.0)),  # neither
        (4, "ONTARIO", None, 4, 4326, at(-78.0, 43.0)),  # name in other case: candidate, not listed
        (5, "Lake Huron", "united states", 5, 4326, at(-82.0, 45.0)),  # mention only
        (6, "Superior", "Canada", 6, 4326, at(-88.0, 47.0)),
        (7, None, "United States", 7, 4326, at(-88.0, 47.0)),
        (8, "Huron", "Canada", 8, 4326, at(-82.0, 44.0, 0.001)),  # nothing left inside 300 m
    ]
    return spark.createDataFrame(rows, f"Hylak_id long, Lake_name string, Country string, part long, srid int, rings {RINGS.simpleString()}")


def test_catalogue(spark):
    cand = catalogue.candidate_lakes(catalogue_rows(spark))
    assert sorted(r["Hylak_id"] for r in cand.collect()) == [1, 2, 4, 5, 6, 8]
    lakes = catalogue.study_lakes(cand, strict=False, step_m=100.0)
    got = sorted((r["lake_id"], r["lake_name"], r["part"]) for r in lakes.where("part < 9").collect())
    assert got == [("GL-1", "Erie", 1), ("GL-1", "Erie", 2), ("GL-2", "Superior", 6)]
    with pytest.raises(SchemaError):
        catalogue.study_lakes(cand)


def test_dissolve_takes_first_attributes(spark):
    out = spatial.dissolve(catalogue_rows(spark), "Lake_name", ["Country"], "Hylak_id")
    got = {r["Hylak_id"]: r["Country"] for r in out.collect()}
    assert got[1] == got[2] == got[3] == "United States of America" and 7 not in got


def test_membership_joins_time_cube(spark):
    from limnia.plans.climate import lake_climate

    grid = spark.createDataFrame(
        [(y, x, -90.0 + x * 0.1, 45.0 + y * 0.1) for y in range(5) for x in range(5)], "y int, x int, lon double, lat double")
    ring = [(-90.05, 44.95), (-89.75, 44.95), (-89.75, 45.15), (-90.05, 45.15)]  # x 0..2, y 0..1
    cube = grid.select("y", "x", F.explode(F.array(F.lit("2024-01-01"), F.lit("2024-01-02"))).alias("time")).select(
        "*", F.explode(F.array(F.lit("tmin"), F.lit("tmax"))).alias("var"))
    value = F.when((F.col("var") == "tmax") & (F.col("time") == "2024-01-02"), F.lit(float("nan"))).otherwise(F.col("x") + 0.0)
    out = lake_climate(cube.withColumn("value", value), grid, polygons(spark, ("L", 0, [ring])), ("tmin", "tmax"))
    got = {str(r["date"])[:10]: (r["lake_name"], r["tmin"], r["tmax"]) for r in out.collect()}
    assert got == {"2024-01-01": ("L", 1.0, 1.0), "2024-01-02": ("L", 1.0, None)}


def test_membership_as_runs(spark):
    from limnia.operators.zonal import in_runs, row_runs

    grid = spark.range(120 * 200).selectExpr(
        "cast(id div 200 AS int) AS y", "cast(id % 200 + 900 AS int) AS x", "(id % 200) * 0.02D AS lon", "(id div 200) * 0.02D AS lat")
    polys = polygons(spark, ("ring", 0, [[(0.11, 0.11), (3.9, 0.11), (3.9, 2.2), (0.11, 2.2)], [(1.0, 1.0), (3.0, 1.0), (3.0, 2.0), (1.0, 2.0)]]),
                     ("arrow", 1, [[(0.5 * x, 0.5 * y) for x, y in ARROW]]))
    members = spatial.lake_pixels(grid, polys).cache()
    runs = row_runs(members)
    assert runs.count() < members.count() / 10
    # runs cross the tiles' bounds, and overlapping lakes both get a pixel
    got = in_runs(grid, runs)
    want = grid.join(members, ["y", "x"]).select(*got.columns)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    gappy = members.where("x % 7 <> 3")
    back = in_runs(grid, row_runs(gappy)).select("lake_id", "y", "x")
    assert back.count() == gappy.count() and back.exceptAll(gappy.select("lake_id", "y", "x")).count() == 0


def test_pixels_of_an_unlisted_file_fail_the_job(spark):
    from limnia.plans import extraction

    px = spark.createDataFrame([("a.20240105.L3m.DAY.x.nc", 1.5, 1.5, 0.002), ("b.20240106.L3m.DAY.x.nc", 1.6, 1.5, 0.004)],
                               "src string, lon double, lat double, CI_cyano double")
    boxes = spark.createDataFrame([("a", 1.0, 1.0, 2.0, 2.0)], "lake_id string, minx double, miny double, maxx double, maxy double")
    files = px.select("src")
    assert extraction.extract_lakes(px, boxes, files, "daily").count() == 2
    with pytest.raises(Exception, match="does not list"):
        extraction.extract_lakes(px, boxes, files.limit(1), "daily").collect()
    read = files.withColumn("engine", F.when(F.col("src").startswith("a"), "primary"))
    assert [r["engine"] for r in extraction.regional_series(px, read, "daily").collect()] == ["primary"]
    with pytest.raises(Exception, match="does not list"):
        extraction.regional_series(px, read.where("engine IS NOT NULL"), "daily").collect()


def test_means_of_lakes_on_each_other_share_sums(spark, monkeypatch):
    """means by shared stretches are those of the pixels, and few rows meet the lakes."""
    from limnia.operators import zonal

    runs = spark.range(300).selectExpr(
        "concat('L', id % 100) AS lake_id", "if(id % 3 = 0, null, 'n') AS lake_name", "cast(id % 3 AS int) AS y",
        "cast(id * 7 % 500 - 300 AS int) AS x_from", "cast(id * 7 % 500 - 300 + 1 + id * 13 % 700 AS int) AS x_to")
    pieces = zonal.stretches(runs.withColumn("run", F.struct("x_from", "x_to")))
    pixels = pieces.selectExpr("lake_id", "y", "run", "explode(sequence(stretch * (1 << level), (stretch + 1) * (1 << level) - 1)) AS x")
    want = runs.selectExpr("lake_id", "y", "struct(x_from, x_to) AS run", "explode(sequence(x_from, x_to)) AS x")
    assert pixels.count() == want.count() and pixels.exceptAll(want.withColumn("x", F.col("x").cast("bigint"))).count() == 0
    cube = spark.range(12000).selectExpr(
        "cast(id % 3 AS int) AS y", "if(id % 101 = 0, null, cast(id * 11 % 1100 - 350 AS int)) AS x", "if(id % 7 = 0, null, id % 4) AS date",
        "if(id % 5 < 2, 'a', if(id % 5 = 4, 'other', 'b')) AS var", "if(id % 9 = 0, null, cast(id % 1000 AS float)) AS value")
    read = []
    for shared in (1e9, zonal.SHARED):
        monkeypatch.setattr(zonal, "SHARED", shared)
        read.append({(r["lake_id"], r["lake_name"], r["date"]): (r["a"], r["b"]) for r in zonal.member_means(cube, runs, ["date"], ("a", "b")).collect()})
    assert read[0].keys() == read[1].keys() and len(read[0]) > 400
    for k, means in read[0].items():
        assert read[1][k] == tuple(x if x is None else pytest.approx(x, rel=1e-12) for x in means)
    plans = []
    monkeypatch.setattr(zonal, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    zonal.member_means(cube, runs, ["date"], ("a", "b"))
    assert plans[0].count("Exchange ") == 3  # by place, by place, by lake
