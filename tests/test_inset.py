import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnia.functions.geometry import albers, albers_inverse
from limnia.operators import inset, spatial
from limnia.sources.tables import RINGS

SCHEMA = f"lake_id string, lake_name string, part long, srid int, rings {RINGS.simpleString()}"


def shores(spark, far, **lakes):
    rows = []
    for k, rings in lakes.items():
        for ring in rings:
            rows += [(k, *map(float, a), *map(float, b), far) for a, b in zip(ring, ring[1:] + ring[:1])]
    return spark.createDataFrame(rows, "lake_id string, x1 double, y1 double, x2 double, y2 double, inset_m double")


RECT = [(0, 0), (400, 0), (400, 300), (0, 300)]
HOLE = [(100, 100), (200, 100), (200, 200), (100, 200)]


@pytest.mark.parametrize("step", [1.0, 5.0])
def test_area_matches_closed_forms(spark, step):
    lakes = {
        "rect": [RECT], "holed": [RECT, HOLE], "slanted": [[(0, 0), (300, 400), (-100, 700), (-400, 300)]], "tri": [[(0, 0), (1000, 0), (0, 1000)]],
        "split": [[(0, 0), (100, 0), (100, 45), (150, 45), (150, 0), (250, 0), (250, 100), (150, 100), (150, 55), (100, 55), (100, 100), (0, 100)]],
        "gone": [[(0, 0), (19, 0), (19, 500), (0, 500)]],
    }
    leg = 1000 - 20 - 10 * math.sqrt(2)
    want = {
        "rect": 380 * 280, "holed": 380 * 280 - (100 * 100 + 4 * 100 * 10 + math.pi * 100), "slanted": 480 * 480, "tri": leg * leg / 2,
        # two squares whose channel is too narrow; shore points of its mouths reach into them
        "split": 2 * (80 * 80),
    }
    got = {r["lake_id"]: r["area_m2"] for r in inset.inset_area(shores(spark, 10.0, **lakes), step).collect()}
    assert set(got) == set(want)
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=2e-3 if k == "split" else 3e-4), k


def test_stretches_equal_distances(spark):
    """Free stretches of a concave shape against the distance of many points."""
    ring = [(0, 0), (200, 20), (90, 80), (210, 160), (20, 190), (60, 90)]
    df = shores(spark, 12.0, a=[ring])
    free = {}
    for r in inset.free_stretches(df, 7.0).collect():
        free.setdefault(r["y"], []).append((r["x_from"], r["x_to"]))
    xs = np.arange(-20, 230, 0.25) + 0.1

    def far(x, y):
        best, odd = math.inf, False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            t = max(0, min(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2)))
            best = min(best, math.hypot(x - x1 - t * (x2 - x1), y - y1 - t * (y2 - y1)))
            odd ^= (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        return best if odd else -1

    for y in np.arange(-1, 30) * 7.0 + 3.5:
        for x in xs:
            d = far(x, y)
            if abs(d - 12) > 1e-6:
                assert (d > 12) == any(a < x < b for a, b in free.get(y, [])), (x, y)


def test_box_reaches_the_corners_whatever_the_spacing(spark):
    ring = [(-90.0, 45.0), (-89.9, 45.01), (-89.92, 45.06), (-90.0, 45.05)]
    polys = spark.createDataFrame([("a", "a", 0, 4326, [ring])], SCHEMA).withColumn("inset_m", F.lit(300.0))
    boxes = [tuple(spatial.lake_boxes(polys, step_m=s).first())[1:] for s in (20.0, 400.0)]
    assert boxes[0] == pytest.approx(boxes[1], abs=1e-8)
    # a convex lake: the corners are where neighbouring sides meet after moving inwards
    x, y = albers(F.col("lon"), F.col("lat"))
    p = np.array([tuple(r) for r in spark.createDataFrame([(i, *q) for i, q in enumerate(ring)], "i int, lon double, lat double").select(
        "i", x.alias("x"), y.alias("y")).orderBy("i").select("x", "y").collect()])
    corners = []
    for i in range(4):
        sides = []
        for a, b in ((p[i - 1], p[i]), (p[i], p[(i + 1) % 4])):
            d = (b - a) / np.linalg.norm(b - a)
            n = np.array([-d[1], d[0]])  # the ring runs counter-clockwise
            sides.append((n, n @ a + 300.0))
        corners.append(np.linalg.solve(np.array([s[0] for s in sides]), np.array([s[1] for s in sides])))
    lon, lat = albers_inverse(F.col("x"), F.col("y"))
    back = np.array([tuple(r) for r in spark.createDataFrame([tuple(map(float, c)) for c in corners], "x double, y double").select(lon, lat).collect()])
    assert boxes[0] == pytest.approx((*back.min(axis=0), *back.max(axis=0)), abs=1e-7)


def test_united_parts_and_lakes_without_rest(spark):
    halves = [[(-90.0, 45.0), (-89.95, 45.0), (-89.95, 45.05), (-90.0, 45.05)], [(-89.95, 45.0), (-89.9, 45.0), (-89.9, 45.05), (-89.95, 45.05)]]
    rows = [("two", "two", i, 4326, [r]) for i, r in enumerate(halves)] + [("tiny", "tiny", 0, 4326, [[(-88.0, 45.0), (-87.999, 45.0), (-87.999, 45.001)]])]
    polys = spark.createDataFrame(rows, SCHEMA)
    assert [r["lake_id"] for r in spatial.lake_boxes(polys, inset_m=300.0).collect()] == ["two"]
    area = {r["lake_id"]: r["area_m2"] for r in spatial.lake_area(polys, inset_m=300.0).collect()}
    whole = {r["lake_id"]: r["area_m2"] for r in spatial.lake_area(polys).collect()}
    assert set(area) == {"two"} and 0.82 < area["two"] / whole["two"] < 0.83
