"""How steps whose rows outgrow their tables are spread: by counts, and never by broadcasting what grew."""

from __future__ import annotations

from limnia.operators import inset, spatial, zonal

EDGE = "lake_id string, part long, ring int, x1 double, y1 double, x2 double, y2 double"
SIDES = [(0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 4.0), (4.0, 4.0, 0.0, 4.0), (0.0, 4.0, 0.0, 0.0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shores(spark, side, inset_m):
    rows = [("a", x1 * side, y1 * side, x2 * side, y2 * side, inset_m) for x1, y1, x2, y2 in SIDES]
    return spark.createDataFrame(rows, "lake_id string, x1 double, y1 double, x2 double, y2 double, inset_m double")


def test_edges_in_many_bands_are_not_broadcast_and_points_are_shuffled_once(spark):
    lake = spark.createDataFrame([("a", 0, 0, *s) for s in SIDES], EDGE).drop("part")
    points = spark.createDataFrame([(0, 1.0, 1.0, "a"), (1, 5.0, 1.0, "a"), (2, 4.0, 2.0, "a"), (3, 3.9, 3.9, "a")],
                                   "pid long, px double, py double, lake_id string")
    found = spatial.points_inside(points, lake, ["pid"], 2e-5)  # 400,000 edge rows
    assert "Broadcast" not in plan(found)
    assert plan(found).count("Exchange") == 2  # points and edges, nothing after the join
    assert {r["pid"] for r in found.collect()} == {0, 3}


def test_many_lake_cells_are_not_broadcast(spark):
    boxes = spark.createDataFrame([("a", 0.0, 0.0, 4.0, 4.0)], "lake_id string, minx double, miny double, maxx double, maxy double")
    pixels = spark.createDataFrame([(0, 1.0, 1.0), (1, 5.0, 1.0), (2, 4.0, 4.0)], "pid long, lon double, lat double")
    found = zonal.pixels_in_boxes(pixels, boxes, 0.008)  # 251,001 cells
    assert "Broadcast" not in plan(found)
    assert {r["pid"] for r in found.collect()} == {0, 2}
    few = zonal.pixels_in_boxes(pixels, boxes)
    assert "BroadcastHashJoin" in plan(few)


def test_scan_lines_are_made_where_they_are_swept(spark):
    free = inset.free_stretches(shores(spark, 25_000.0, 300.0), 0.05)
    text = plan(free)
    assert text.count("Exchange") == 1  # the edges
    assert "block" in text and ", 4), REPARTITION_BY_NUM" in text  # 4 of the session
    assert ", 8), REPARTITION_BY_NUM" in plan(inset.free_stretches(shores(spark, 50_000.0, 300.0), 0.05))


def test_corners_are_looked_for_in_as_many_tasks_as_edges_need(spark, monkeypatch):
    plans, keep = [], inset.materialise
    monkeypatch.setattr(inset, "CELLS_A_TASK", 1)
    monkeypatch.setattr(inset, "materialise", lambda df: plans.append(plan(df)) or keep(df))

    def inside(points, edges):
        named = points.withColumns({"qx": points["px"], "qy": points["py"]})
        return spatial.points_inside(named, edges, ["qx", "qy"], 2000.0).withColumnsRenamed({"qx": "px", "qy": "py"})

    box = inset.inset_boxes(shores(spark, 5_000.0, 300.0), inside, 500.0).first()
    assert box.minx < box.maxx and box.miny < box.maxy
    spread = [p for p in plans if "hashpartitioning(lake_id" in p and "cx#" in p and "REPARTITION_BY_NUM" in p]
    assert spread and spread[-1].count("SHUFFLE_HASH") == 0 and ", 4), REPARTITION_BY_NUM" not in spread[-1]
