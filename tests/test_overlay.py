import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from limnia.operators import overlay, spatial
from limnia.sources.tables import RINGS

SCHEMA = f"lake_id string, lake_name string, part long, srid int, rings {RINGS.simpleString()}"


def rect(x0, y0, x1, y1):
    return [(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]


CASES = {  # rings of the parts, area of the union, edges around it
    "halves": ([rect(0, 0, 1, 2), rect(1, 0, 2, 2)], 4, 6),
    "partly": ([rect(0, 0, 1, 2), rect(1, 0, 2, 0.75), rect(1, 0.75, 2, 2)], 4, 7),
    "over": ([rect(0, 0, 1.3, 2), rect(0.8, 0, 2, 2)], 4, 8),
    "cross": ([rect(0, 0.5, 2, 1.5), rect(0.5, 0, 1.5, 2)], 3, 12),
    "within": ([rect(0, 0, 2, 2), rect(0.5, 0.5, 1, 1)], 4, 4),
    "twice": ([rect(0, 0, 2, 2), rect(0, 0, 2, 2)], 4, 4),
    "slanted": ([[(0.0, 0.0), (2.0, 2.0), (0.0, 2.0)], [(2.0, 2.0), (0.0, 0.0), (2.0, 0.0)]], 4, 4),
    "three": ([[(0.0, 0.0), (2.0, 0.0), (0.0, 2.0)], [(2.0, 2.0), (0.0, 2.0), (2.0, 0.0)], [(0.3, 0.1), (1.9, 0.2), (1.0, 1.7)]], 4, 4),
    "frame": ([rect(0, 0, 3, 1), rect(0, 2, 3, 3), rect(0, 0, 1, 3), rect(2, 0, 3, 3)], 8, 16),  # a hole arises
    "apart": ([rect(0, 0, 1, 1), rect(5, 5, 6, 6)], 2, 8),
    "corner": ([rect(0, 0, 1, 1), rect(1, 1, 2, 2)], 2, 8),
}


def polygons(spark, cases, dx=0.0, dy=0.0):
    rows = [(k, k, i, 4326, [[(x + dx, y + dy) for x, y in ring]]) for k, rings in cases.items() for i, ring in enumerate(rings)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("shift", [(0.0, 0.0), (-90.0, 44.0)])
def test_union_of_two_and_more_parts(spark, shift):
    out = overlay.union_outline(spatial.edges(polygons(spark, {k: c[0] for k, c in CASES.items()}, *shift)))
    got = {r["lake_id"]: (r["a"], r["n"]) for r in out.groupBy("lake_id").agg(
        (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("a"), F.count("*").alias("n")).collect()}
    for k, (_, area, n) in CASES.items():
        assert got[k] == (pytest.approx(area, abs=1e-6), n), k
    # every outline is closed: each point is left as often as it is reached
    ends = out.select("lake_id", "x1", "y1", F.lit(1).alias("n")).union(out.select("lake_id", "x2", "y2", F.lit(-1)))
    assert ends.groupBy("lake_id", "x1", "y1").agg(F.sum("n").alias("n")).where("n <> 0").count() == 0


def star(rng, n):
    """A concave ring around a random centre."""
    cx, cy, turn = rng.uniform(0, 3), rng.uniform(0, 3), rng.uniform(0, 6)
    return [(cx + r * math.cos(turn + 2 * math.pi * i / n), cy + r * math.sin(turn + 2 * math.pi * i / n))
            for i, r in enumerate(rng.uniform(0.3, 1.5) for _ in range(n))]


def crossings(ring, y):
    return sorted((x2 - x1) * (y - y1) / (y2 - y1) + x1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]) if (y1 > y) != (y2 > y))


def width(rings, y):
    """Length of the union's stretch on a level line."""
    spans = sorted((xs[i], xs[i + 1]) for xs in (crossings(r, y) for r in rings) for i in range(0, len(xs), 2))
    total, end = 0.0, -math.inf
    for a, b in spans:
        total += max(0.0, b - max(a, end))
        end = max(end, b)
    return total


def test_random_stars_equal_plain_union(spark):
    rng = random.Random(4)
    cases = {f"s{k}": [star(rng, rng.randrange(3, 9)) for _ in range(rng.randrange(2, 7))] for k in range(12)}
    polys = polygons(spark, cases)
    out = overlay.union_outline(spatial.edges(polys))
    area = {r["lake_id"]: r["area_m2"] for r in spatial.outline_area(out).collect()}
    for k, rings in cases.items():
        ys = np.linspace(-2, 5, 7001)[:-1] + 0.0005
        assert area[k] == pytest.approx(sum(width(rings, y) for y in ys) * 0.001, abs=2e-3), k
    pts = [(rng.uniform(-1, 4), rng.uniform(-1, 4)) for _ in range(400)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "pid long, px double, py double")
    cand = df.crossJoin(polys.select("lake_id").distinct())
    got = {tuple(r) for r in spatial.points_inside(cand, out, ["pid"], 0.5).select("pid", "lake_id").collect()}
    inside = lambda ring, x, y: sum(c > x for c in crossings(ring, y)) % 2 == 1
    assert got == {(i, k) for i, p in enumerate(pts) for k, rings in cases.items() if any(inside(r, *p) for r in rings)}


def test_lakes_cut_in_different_ways_have_equal_pixels(spark):
    cases = {k: CASES[k][0] for k in ("halves", "partly", "over", "slanted", "twice", "within")} | {"one": [rect(0, 0, 2, 2)]}
    polys = polygons(spark, cases, -90.0, 44.0)
    grid = spark.range(41 * 41).selectExpr(
        "cast(id div 41 AS int) AS y", "cast(id % 41 AS int) AS x", "-90 + (id % 41) * 0.05 AS lon", "44 + (id div 41) * 0.05 AS lat")
    for inset in (None, 3000.0):
        sets = {}
        for r in spatial.lake_pixels(grid, polys, inset).collect():
            sets.setdefault(r["lake_id"], set()).add((r["y"], r["x"]))
        assert len(sets["one"]) == 1521 and all(s == sets["one"] for s in sets.values())
    area = {r["lake_id"]: r["area_m2"] for r in spatial.expected_pixel_table(polys).collect()}
    # points where parts meet stay, so that straight edges bend a little in the projection
    assert all(a == pytest.approx(area["one"], rel=1e-4) for a in area.values())
    assert area["slanted"] == area["twice"] == area["within"] == area["one"]


def test_edges_with_holes_null_lakes_and_one_part(spark):
    ring, hole = rect(0, 0, 4, 4), rect(1, 1, 3, 3)
    rows = [("h", "h", 0, 4326, [ring, hole]), ("h", "h", 1, 4326, [rect(2, 2, 5, 5)]), ("o", "o", 0, 4326, [ring, hole]),
            (None, None, 1, 4326, [ring]), (None, None, 2, 4326, [ring]), ("e", "e", 0, 4326, []), ("e", "e", 1, 4326, [ring])]
    polys = spark.createDataFrame(rows, SCHEMA)
    many = overlay.several_parts(polys)
    assert {r[0] for r in many.collect()} == {"h", "e"}
    out = overlay.outlines(spatial.edges(polys), many)
    n = {r["lake_id"]: r["n"] for r in out.groupBy("lake_id").agg(F.count("*").alias("n")).collect()}
    assert n["o"] == 8 and n["e"] == 4 and n[None] == 8
    area = spatial.outline_area(out.where("lake_id IN ('h', 'e')"))
    # 16 - 4 of the holed part, 9 of the other; they share 7 - (3 - 2)**2 of it
    assert {r[0]: r[1] for r in area.collect()} == {"h": pytest.approx(12 + 9 - 3), "e": pytest.approx(16)}
    assert overlay.several_parts(polys.where("lake_id = 'o'")) is None


def test_many_parts_are_united_in_lots_of_neighbours(spark):
    """A chain of overlapping squares is one outline; no lot has more than ``LOT`` parts, whose squares are then gone."""
    n = 300
    rows = []
    for i in range(n):
        x, y = (i * 37 % n) * 0.25, 0.125 * (i % 2)
        ring = [(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0)]
        rows += [("a", i, *p, *q) for p, q in zip(ring, ring[1:] + ring[:1])]
    edges = spark.createDataFrame(rows, "lake_id string, part long, x1 double, y1 double, x2 double, y2 double")
    last = overlay.gathered(edges)
    assert last.select("part").distinct().count() <= overlay.LOT
    assert last.count() < edges.count()
    few = edges.where(f"part < {overlay.LOT}")
    assert overlay.gathered(few) is few

    def area(e):
        return e.selectExpr("sum(x1 * y2 - x2 * y1) / 2 AS a").first().a

    assert area(overlay.union_outline(edges)) == pytest.approx(area(overlay._united(edges, "lake_id")), abs=1e-6)
