"""Polygons as edge tables: bounds, area, membership, inset, dissolve.

A polygon table has one row per part: ``lake_id, lake_name, part, srid, rings``, where
``rings`` is ARRAY<ARRAY<STRUCT<x, y>>> with the outer ring first and holes after it. A lake
of many parts is many rows, so no geometry is ever collected into one row, and dissolving is
a relabelling. Parts of a lake may touch or overlap: its shore, area and inset are those of
their union (``operators.overlay``).

Work happens on *edges*, one row per ring segment. Point tests join points to edges through
horizontal bands: only the edges that can matter to a point meet it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.functions.geometry import albers, edge_meets_box, on_segment, ray_hits, segment_distance_sq
from limnia.functions.flags import PIX_RES_M, expected_pixels
from limnia.operators.inset import STEP_M, inset_area, inset_boxes
from limnia.operators.overlay import outlines, several_parts, union_outline
from limnia.operators.zonal import pixels_in_boxes
from limnia.session import materialise

_XY = ("x1", "y1", "x2", "y2")
# Beyond so many rows the edges in bands are not left to the planner, which sees the size of the
# polygons and not what bands make of them; a task of the join then gets about half as many.
BANDED_ROWS = 200_000


def edges(polygons: DataFrame, keep: Sequence[str] = ("lake_id", "part")) -> DataFrame:
    """Ring segments: keep columns, ``ring`` (0 = outer), x1, y1, x2, y2. Rings close themselves."""
    rings = polygons.select(*keep, F.posexplode("rings").alias("ring", "pts"))
    steps = F.sequence(F.lit(0), F.size("pts") - 1)
    at = rings.where(F.size("pts") > 0).select(*keep, "ring", "pts", F.explode(steps).alias("i"))
    a = F.col("pts")[F.col("i")]
    b = F.col("pts")[(F.col("i") + 1) % F.size("pts")]
    out = at.select(
        *keep, "ring", a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
    )
    return out.where("x1 <> x2 OR y1 <> y2")


def to_metres(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Replace longitude/latitude column pairs by equal-area metres."""
    new = {}
    for x, y in pairs:
        new[x], new[y] = albers(F.col(x), F.col(y))
    return df.withColumns(new)


def edges_in_metres(edge_table: DataFrame) -> DataFrame:
    return to_metres(edge_table, [("x1", "y1"), ("x2", "y2")])


def bounds(edge_table: DataFrame, *keys: str) -> DataFrame:
    """Bounding box per key; per lake unless keys are given."""
    return edge_table.groupBy(*(keys or ("lake_id",))).agg(
        F.min(F.least("x1", "x2")).alias("minx"), F.min(F.least("y1", "y2")).alias("miny"),
        F.max(F.greatest("x1", "x2")).alias("maxx"), F.max(F.greatest("y1", "y2")).alias("maxy"),
    )


def area(edge_table: DataFrame, key: str = "lake_id") -> DataFrame:
    """Shoelace area per lake: outer rings minus holes, summed over parts."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    rings = edge_table.groupBy(key, "part", "ring").agg((F.abs(F.sum(cross)) / 2).alias("a"))
    signed = F.when(F.col("ring") == 0, F.col("a")).otherwise(-F.col("a"))
    return rings.groupBy(key).agg(F.sum(signed).alias("area_m2"))


def outline_area(outline: DataFrame, key: str = "lake_id") -> DataFrame:
    """Area per lake of a union outline, whose edges have the lake on their left."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    return outline.groupBy(key).agg((F.sum(cross) / 2).alias("area_m2"))


def points_inside(
    candidates: DataFrame, edge_table: DataFrame, point: Sequence[str], band: float,
    inset: float = 0.0, px: str = "px", py: str = "py", key: str = "lake_id",
) -> DataFrame:
    """Of the (point, lake) candidates, those strictly inside, boundary excluded.

    ``inset`` keeps only points at least that far from every shore of the lake; an edge table
    with a column ``inset_m`` states it lake by lake. An edge table with a column ``part`` is
    united first; one without is taken as the lakes' outlines. ``band`` is the height of the
    bands joining points to edges; an edge is listed in every band it reaches, widened by the
    inset, so both the ray test and the distance test see every edge that can change their answer. Pairs that neither cross the ray nor block
    the point are dropped inside the join; the rest is combined before the shuffle.
    """
    own = "inset_m" in edge_table.columns
    far = F.coalesce("inset_m", F.lit(0.0)) if own else F.lit(float(inset))
    shores = outlines(edge_table, several_parts(edge_table, key), key) if "part" in edge_table.columns else edge_table
    shores = shores.withColumn("far", far)
    lo = F.floor((F.least("y1", "y2") - F.col("far")) / band).cast("bigint")
    hi = F.floor((F.greatest("y1", "y2") + F.col("far")) / band).cast("bigint")
    held = materialise(shores.select(key, "far", *_XY, lo.alias("lo"), hi.alias("hi")))
    n = held.agg(F.coalesce(F.sum(F.expr("hi - lo + 1")), F.lit(0))).first()[0]
    banded = held.withColumn("band", F.explode(F.sequence("lo", "hi"))).drop("lo", "hi")
    pts = candidates.select(*point, key, px, py)
    pts = pts.distinct() if "part" in candidates.columns else pts
    pts = pts.withColumn("band", F.floor(F.col(py) / band).cast("bigint"))
    if n > BANDED_ROWS:
        # spread by a count that adaptive execution keeps; the sides must not be broadcast
        tasks = max(int(held.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * n // BANDED_ROWS)
        pts = pts.repartition(tasks, key, "band")
        banded = banded.repartition(tasks, key, "band").hint("shuffle_hash")
    args = [F.col(c) for c in (px, py, *_XY)]
    blocked = on_segment(*args)
    if inset or own:
        blocked = blocked | (F.sqrt(segment_distance_sq(*args)) < F.col("far"))
    pairs = pts.join(banded, [key, "band"]).withColumns({"hit": ray_hits(*args), "blocked": blocked})
    # a point is in one band: grouped with it, the rows of a point are where the join left them
    tested = pairs.where("hit OR blocked").groupBy(key, "band", *point).agg(
        F.count_if("hit").alias("hits"), F.bool_or("blocked").alias("blocked")
    )
    return tested.where("hits % 2 = 1 AND NOT blocked").select(*point, key)


def _with_inset(polygons: DataFrame, inset_m: float | None) -> tuple[DataFrame, bool]:
    """Polygons that state their inset, and whether any has one to be stated.

    A given ``inset_m`` counts for every lake; without one the polygons' own column does.
    """
    if inset_m is not None:
        return polygons.withColumn("inset_m", F.lit(abs(float(inset_m)))), bool(inset_m)
    if "inset_m" in polygons.columns:
        return polygons.withColumn("inset_m", F.abs(F.coalesce(F.col("inset_m").cast("double"), F.lit(0.0)))), True
    return polygons.withColumn("inset_m", F.lit(0.0)), False


def lake_pixels(
    grid: DataFrame, polygons: DataFrame, inset_m: float | None = None, cell: float | None = None,
    band: float | None = None,
) -> DataFrame:
    """Membership table ``lake_id, y, x``: grid pixels strictly inside each lake.

    ``grid`` is (y, x, lon, lat), one row per pixel of the product, independent of time. A
    box join by grid cell comes first; the polygon test sees only pixels inside a lake's
    bounds. With an inset (given, or a column of ``polygons``) the test runs in equal-area
    metres.
    """
    polygons, any_inset = _with_inset(polygons, inset_m)
    deg = edges(polygons, ["lake_id", "part", "inset_m"])
    shores = outlines(deg, several_parts(polygons))
    grid = grid.withColumns({"px": F.col("lon"), "py": F.col("lat")})
    if any_inset:
        # both tables in metres, the grid before its pixels meet lakes; straight degree edges
        # become straight metre edges, as in a reprojected polygon table
        near = pixels_in_boxes(to_metres(grid, [("px", "py")]), bounds(deg), cell)
        return points_inside(near, edges_in_metres(shores), ["y", "x"], band or 2000.0)
    near = pixels_in_boxes(grid, bounds(deg), cell)
    return points_inside(near, shores.drop("inset_m"), ["y", "x"], band or 0.05)


def lake_area(polygons: DataFrame, inset_m: float | None = None, step_m: float = STEP_M) -> DataFrame:
    """``lake_id, area_m2`` in equal-area metres: exact without inset, by scan lines ``step_m`` apart with one."""
    polygons, any_inset = _with_inset(polygons, inset_m)
    whole = polygons.where("inset_m = 0")
    many = several_parts(whole)
    deg = edges(whole)
    if many is None:
        exact = area(edges_in_metres(deg))
    else:  # united in degrees, as the parts are given
        united = union_outline(deg.join(many, "lake_id", "left_semi"))
        exact = area(edges_in_metres(deg.join(many, "lake_id", "left_anti"))).unionByName(outline_area(edges_in_metres(united)))
    if not any_inset:
        return exact
    return exact.unionByName(inset_area(inset_shores(polygons), step_m))


def inset_shores(polygons: DataFrame) -> DataFrame:
    """Outlines in metres, with ``inset_m``, of the polygons that state one above zero."""
    inset = polygons.where("inset_m > 0")
    return edges_in_metres(outlines(edges(inset, ["lake_id", "part", "inset_m"]), several_parts(inset)))


def lake_boxes(polygons: DataFrame, inset_m: float | None = None, step_m: float = STEP_M) -> DataFrame:
    """``lake_id, minx, miny, maxx, maxy`` in degrees of each lake, or of what its inset leaves.

    With an inset the box reaches to the outermost corners of what is left; the scan lines'
    spacing only decides how many corners have to be looked at (and whether a remainder
    narrower than it is seen at all).
    """
    polygons = polygons.where("lake_id IS NOT NULL AND rings IS NOT NULL")
    polygons, any_inset = _with_inset(polygons, inset_m)
    whole = bounds(edges(polygons.where("inset_m = 0")))
    if not any_inset:
        return whole

    def inside(points, shores):
        named = points.withColumns({"qx": F.col("px"), "qy": F.col("py")})
        return points_inside(named, shores, ["qx", "qy"], 2000.0).withColumnsRenamed({"qx": "px", "qy": "py"})

    return whole.unionByName(inset_boxes(materialise(inset_shores(polygons)), inside, step_m))


def expected_pixel_table(
    polygons: DataFrame, inset_m: float | None = None, pix_res_m: float = PIX_RES_M, step_m: float = STEP_M
) -> DataFrame:
    """``lake_id, area_m2, expected_pixels_geom, lake_name`` for coverage ratios."""
    names = polygons.groupBy("lake_id").agg(F.min_by("lake_name", "part").alias("lake_name"))
    sized = lake_area(polygons, inset_m, step_m).withColumn(
        "expected_pixels_geom", expected_pixels("area_m2", pix_res_m)
    )
    return names.join(sized, "lake_id", "left").select(
        "lake_id", "area_m2", "expected_pixels_geom", "lake_name"
    )


def intersects_box(
    polygons: DataFrame, minx: float, miny: float, maxx: float, maxy: float, key: str = "lake_id"
) -> DataFrame:
    """Keys of polygons sharing a point with the box.

    True when an edge meets the box, or when no edge does but the box lies inside a part
    (one box corner decides, by ray parity over that part's edges). One grouped pass.
    """
    xy = [F.col(c) for c in _XY]
    meets = edge_meets_box(*xy, minx, miny, maxx, maxy)
    corner = ray_hits(F.lit(minx), F.lit(miny), *xy)
    parts = edges(polygons, [key, "part"]).groupBy(key, "part").agg(
        F.bool_or(meets).alias("meets"), F.count_if(corner).alias("hits")
    )
    return parts.where(F.col("meets") | (F.col("hits") % 2 == 1)).select(key).distinct()


def dissolve(polygons: DataFrame, name: str, first: Sequence[str] = (), order: str = "part") -> DataFrame:
    """Merge polygons of one exact name: every part keeps its rings and gets the group's name.

    ``first`` columns take the value of the group's earliest part. Parts without a name are
    dropped, as a grouping by name does.
    """
    named = polygons.where(F.col(name).isNotNull())
    if not first:
        return named
    head = named.groupBy(name).agg(F.min_by(F.struct(*first), F.struct(order)).alias("h"))
    heads = head.select(name, *[F.col(f"h.{c}").alias(c) for c in first])
    return named.drop(*first).join(heads, name)
