"""Lakes that lie on each other share counts by place: same results as meeting each reading, without doing so."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnia.operators import zonal
from limnia.plans import extraction

BOX = "lake_id string, minx double, miny double, maxx double, maxy double"


def rows(df):
    return sorted(
        (str(r["src"]), str(r["lake_id"]), r["n_valid"], *(None if r[c] is None else round(r[c], 9) for c in ("CI_mean", "CI_p90")))
        for r in df.collect()
    )


@pytest.mark.parametrize("ways,keep_empty,seed", [(3, True, 1), (32, False, 2)])
def test_shared_counts_give_the_same_rows(spark, monkeypatch, ways, keep_empty, seed):
    rnd = random.Random(seed)
    readings = [
        (rnd.choice(["a", "a", "b", None]), rnd.randrange(-40, 40) / 8, rnd.randrange(0, 60) / 10,
         rnd.choice([None, float("nan"), 0.0, 0.25, *(rnd.gauss(0, 1) for _ in range(6))]))
        for _ in range(3000)
    ] + [("c", 100.0, 50.0, 1.0), ("c", 1.0, 1.0, None), ("d", 1.0, 1.0, float("nan"))]
    px = spark.createDataFrame(readings, "src string, lon double, lat double, v double")
    # sides on the readings' own places, so that edges count; equal boxes, lakes of several boxes, odd boxes
    boxes = [(f"l{i}", x, y, x + rnd.randrange(0, 30) / 8, y + rnd.randrange(0, 30) / 10)
             for i in range(25) for x, y in [(rnd.randrange(-45, 35) / 8, rnd.randrange(-5, 55) / 10)]]
    boxes += [("same", *boxes[0][1:]), boxes[1], boxes[1], ("l2", -1.0, 0.0, 2.0, 4.0), (None, 0.0, 0.0, 3.0, 3.0), (None, 1.0, 1.0, 2.0, 2.0),
              ("point", 1.0, 1.0, 1.0, 1.0), ("thin", -9.0, 2.0, 9.0, 2.0), ("none", 60.0, 60.0, 61.0, 61.0),
              ("open", None, 0.0, 1.0, 1.0), ("turned", 2.0, 2.0, 1.0, 1.0), ("world", -180.0, -90.0, 180.0, 90.0)]
    lakes = spark.createDataFrame(boxes, BOX)
    monkeypatch.setattr(zonal, "WAYS", ways)
    got = {}
    for shared in (False, True):
        monkeypatch.setattr(zonal, "_crowded", lambda *a, shared=shared: shared)
        got[shared] = zonal.zonal_stats(px, lakes, "v", ["src"], keep_empty=keep_empty)
    assert got[True].dtypes == got[False].dtypes
    assert rows(got[True]) == rows(got[False])


def test_lakes_on_each_other_do_not_meet_their_readings(spark, monkeypatch):
    def refuse(*args):
        raise AssertionError("each reading met each of its lakes")

    monkeypatch.setattr(zonal, "pixels_in_boxes", refuse)
    n, lakes = 20_000, 60
    px = spark.range(n).selectExpr(
        "'f' AS src", "(id * 7919 % 40) / 10D AS lon", "(id * 31 % 37) / 10D AS lat", "cast(id * 104729 % 9973 AS float) AS v")
    boxes = spark.range(lakes).selectExpr(
        "concat('l', id) AS lake_id", "id / 100D AS minx", "0D AS miny", "3 + id / 100D AS maxx", "3D AS maxy")
    got = {r["lake_id"]: r for r in zonal.zonal_stats(px, boxes, "v", ["src"]).collect()}
    assert len(got) == lakes
    i = np.arange(n)
    lon, lat, v = (i * 7919 % 40) / 10, (i * 31 % 37) / 10, (i * 104729 % 9973).astype("float64")
    for k in range(lakes):
        mine = v[(lon >= k / 100) & (lon <= 3 + k / 100) & (lat <= 3)]
        r = got[f"l{k}"]
        assert r["n_valid"] == len(mine)
        assert (r["CI_mean"], r["CI_p90"]) == (pytest.approx(mine.mean()), pytest.approx(np.quantile(mine, 0.9)))


def test_tiles_of_a_lake_are_few_and_hold_each_place_once(spark):
    rnd = random.Random(5)
    boxes = [(f"l{i}", x, y, x + rnd.random() * 3, y + rnd.random() * 3)
             for i in range(40) for x, y in [(rnd.uniform(-5, 5), rnd.uniform(-5, 5))]]
    lakes = spark.createDataFrame(boxes, BOX)
    tiles = zonal.lake_tiles(lakes).cache()
    assert tiles.groupBy("lake_id").count().agg(F.max("count")).first()[0] < 400
    west, south = F.col("cx") * F.col("side"), F.col("cy") * F.col("side")
    outside = (west < F.col("minx")) | (west + F.col("side") > F.col("maxx")) | (south < F.col("miny")) | (south + F.col("side") > F.col("maxy"))
    assert tiles.where(~F.col("shore") & outside).count() == 0
    places = spark.range(10).join(lakes).selectExpr(
        "lake_id AS l", "id", "minx + (maxx - minx) * id / 9 AS lon", "miny + (maxy - miny) * (id * 7 % 10) / 9 AS lat")
    held = places.join(tiles, (F.col("l") == F.col("lake_id")) & (F.floor(F.col("lon") / F.col("side")) == F.col("cx"))
                       & (F.floor(F.col("lat") / F.col("side")) == F.col("cy")))
    assert held.count() == 400 == held.select("l", "id").distinct().count()


def member_rows(seed, lakes=30):
    """Members (lake_id, y, x) of random lakes with holes, most of them on each other, on a grid with negative numbers."""
    rnd = random.Random(seed)
    out = set()
    for i in range(lakes):
        y0, x0, h, w = rnd.randrange(-9, 12), rnd.choice([-300, -5, 0, 0, 250, 500]), rnd.randrange(1, 25), rnd.choice([1, 3, 40, 300])
        hole = rnd.randrange(x0, x0 + w + 1)
        out |= {(f"l{i}", y, x) for y in range(y0, y0 + h) for x in range(x0, x0 + w) if x != hole and (x + y) % 97}
    return sorted(out)


@pytest.mark.parametrize("ways,seed", [(3, 1), (32, 2)])
def test_runs_on_each_other_give_the_same_rows(spark, monkeypatch, ways, seed):
    rnd = random.Random(seed)
    members = member_rows(seed)
    places = sorted({m[1:] for m in members}) + [(100, 100), (0, 5000)]
    readings = [
        (rnd.choice(["a", "a", "b", None]), *rnd.choice(places), rnd.choice([None, float("nan"), float("inf"), 0.0, 0.25, *(rnd.gauss(0, 1) for _ in range(6))]))
        for _ in range(4000)
    ] + [("c", *members[0][1:], None), ("d", *members[-1][1:], float("nan")), ("a", None, 3, 1.0), ("a", 3, None, 1.0)]
    px = spark.createDataFrame(readings, "src string, y int, x int, v float")
    runs = zonal.row_runs(spark.createDataFrame(members, "lake_id string, y int, x int"))
    monkeypatch.setattr(zonal, "WAYS", ways)
    before = spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition")
    got = zonal.run_stats(px, runs, ["src"], "v")
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == before
    want = {}
    held = {}
    for lake, y, x in members:
        held.setdefault((y, x), []).append(lake)
    for src, y, x, v in readings:
        for lake in held.get((y, x), []):
            want.setdefault((src, lake), []).append(v)
    assert got.count() == len(want) > 60
    for r in got.collect():
        mine = np.array([np.float32(v) for v in want[r["src"], r["lake_id"]] if v is not None and np.isfinite(v)], "float64")
        assert r["n_valid"] == len(mine)
        if len(mine):
            assert (r["CI_mean"], r["CI_p90"]) == (pytest.approx(mine.mean(), abs=1e-9), pytest.approx(np.quantile(mine, 0.9), abs=1e-9))
        else:
            assert r["CI_mean"] is None and r["CI_p90"] is None


def test_polygons_on_each_other_do_not_meet_their_readings(spark, monkeypatch):
    """Both ways give the same rows; lakes on each other take the one in which no reading meets a run."""
    ring = lambda d: [[(-1.0 - d, -1.0 - d), (21.0, -1.0 - d), (21.0, 8.0 + d), (-1.0 - d, 8.0 + d), (-1.0 - d, -1.0 - d)]]
    shapes = [(f"l{i}", 1, 4326, ring(i / 7)) for i in range(12)] + [("far", 1, 4326, [[(50.0, 50.0), (51.0, 50.0), (51.0, 51.0), (50.0, 50.0)]])]
    polygons = spark.createDataFrame(shapes, "lake_id string, part int, srid int, rings array<array<struct<x:double,y:double>>>")
    px = spark.range(5000).selectExpr(
        "concat('202', id % 3) AS src", "cast(id * 31 % 7 AS int) AS y", "cast(id * 7919 % 20 AS int) AS x", "cast(id * 104729 % 997 AS float) AS CI_cyano")
    grid = px.select("y", "x", F.col("x").cast("double").alias("lon"), F.col("y").cast("double").alias("lat")).distinct()
    files = px.select("src").distinct().withColumn("time0", F.concat("src", F.lit("-07-01")))

    def made():
        return rows(extraction.extract_lakes_by_polygon(px, polygons, grid, files, "daily", valid_min=0.0, valid_max=900.0))

    monkeypatch.setattr(extraction, "SHARED", 100)
    met = made()
    monkeypatch.undo()

    def refuse(*args):
        raise AssertionError("each reading met each of its lakes")

    monkeypatch.setattr(extraction, "in_runs", refuse)
    assert made() == met and len(met) == 39
