"""What an inset leaves of a lake: the part at least ``inset_m`` away from every shore.

Its area comes from level scan lines. On a line, the lake is the stretches between crossings,
and every shore edge blocks the interval in which the line is nearer than the inset to it
(a capsule meets a line in one interval, whose ends have closed forms). What no edge blocks is
exact, so only the spacing of lines remains: a lake's area is the free length times the spacing.

Its box in degrees is that of its corners, as when a shrunken polygon is reprojected corner by
corner. A corner is a point at the inset's distance from two edges or shore points at once, found for
pairs that share a grid cell and tested against all shores. Round parts of the inset's outline bulge
inwards, so the extremes are corners; those well within the box of the free stretches are none
of them and are not looked at.

Everything is in equal-area metres, on outlines (``operators.overlay``) with a column ``inset_m``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.functions.geometry import albers_inverse
from limnia.operators.overlay import passed_cells
from limnia.session import materialise

STEP_M = 30.0
TURN = 0.5  # radians
# Neighbouring scan lines that are swept in one task, and how many lines of edges a task gets.
LINES = 64
LINES_A_TASK = 1_000_000
# Rows of edges in cells that a task gets where corners are looked for.
CELLS_A_TASK = 20_000
_XY = ("x1", "y1", "x2", "y2")
_BOX = ("minx", "miny", "maxx", "maxy")


def _blocked(y: Column) -> tuple[Column, Column]:
    """Ends of the interval in which the line at height ``y`` is nearer to the edge than the inset; null if it isn't.

    ``nx, ny`` are columns: the step of the inset's length that stands on the edge.
    """
    x1, y1, x2, y2, r, nx, ny = (F.col(c) for c in (*_XY, "inset_m", "nx", "ny"))
    points = []
    for cx, cy in ((x1, y1), (x2, y2)):  # the discs around the ends
        half = F.when(F.abs(y - cy) < r, F.sqrt(r * r - (y - cy) * (y - cy)))
        points += [cx - half, cx + half]
    corners = [(x1 + nx, y1 + ny), (x2 + nx, y2 + ny), (x2 - nx, y2 - ny), (x1 - nx, y1 - ny)]
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):  # the strip along the edge
        points.append(F.when((ay > y) != (by > y), ax + (bx - ax) * (y - ay) / (by - ay)))
    return F.least(*points), F.greatest(*points)


def free_stretches(shores: DataFrame, step_m: float = STEP_M, key: str = "lake_id") -> DataFrame:
    """``key, y, x_from, x_to``: what the inset leaves of the scan lines y = (k + 1/2) * step_m.

    Neighbouring lines go to one task, and edges to each task whose lines they reach: lines are made
    and swept there, so that edges are shuffled and not what lines make of them.
    """
    x1, y1, x2, y2, r = (F.col(c) for c in (*_XY, "inset_m"))
    first = F.ceil((F.least(y1, y2) - r) / step_m - 0.5).cast("bigint")
    last = F.floor((F.greatest(y1, y2) + r) / step_m - 0.5).cast("bigint")
    length = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    reach = shores.select(
        key, *_XY, "inset_m", (-(y2 - y1) / length * r).alias("nx"), ((x2 - x1) / length * r).alias("ny"),
        first.alias("first"), last.alias("last"),
    ).where("first <= last")
    reach = materialise(reach)
    n = reach.agg(F.coalesce(F.sum(F.expr("last - first + 1")), F.lit(0))).first()[0]
    # by a count that adaptive execution keeps and that grows with the lines
    tasks = max(int(shores.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // LINES_A_TASK)
    blocks = F.sequence(F.floor(F.col("first") / LINES).cast("bigint"), F.floor(F.col("last") / LINES).cast("bigint"))
    dealt = reach.withColumn("block", F.explode(blocks)).repartition(tasks, key, "block")
    own = F.sequence(F.greatest(F.col("first"), F.col("block") * LINES), F.least(F.col("last"), F.col("block") * LINES + LINES - 1))
    lines = dealt.withColumn("k", F.explode(own))
    y = (F.col("k") + 0.5) * step_m
    low, high = _blocked(y)
    crossing = F.when((y1 > y) != (y2 > y), x1 + (y - y1) / (y2 - y1) * (x2 - x1))
    met = lines.select(key, "block", "k", crossing.alias("crossing"), low.alias("low"), high.alias("high"))
    events = F.array(
        F.struct(F.col("crossing").alias("x"), F.lit(1).alias("turn"), F.lit(0).alias("depth")),
        F.struct(F.col("low").alias("x"), F.lit(0).alias("turn"), F.lit(1).alias("depth")),
        F.struct(F.col("high").alias("x"), F.lit(0).alias("turn"), F.lit(-1).alias("depth")),
    )
    at = met.select(key, "block", "k", F.inline(events)).where("x IS NOT NULL")
    along = Window.partitionBy(key, "block", "k").orderBy("x")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    swept = at.withColumns({
        "turns": F.sum("turn").over(so_far), "deep": F.sum("depth").over(so_far), "next": F.lead("x").over(along),
    })
    free = swept.where("turns % 2 = 1 AND deep = 0 AND next > x")
    return free.select(key, ((F.col("k") + 0.5) * step_m).alias("y"), F.col("x").alias("x_from"), F.col("next").alias("x_to"))


def inset_area(shores: DataFrame, step_m: float = STEP_M, key: str = "lake_id") -> DataFrame:
    """``key, area_m2`` of what the inset leaves; no row for a lake of which nothing is left.

    The lake is turned first, so that the lines run along no side of a usual shape: the error
    then falls with the square of the spacing.
    """
    cos, sin = math.cos(TURN), math.sin(TURN)
    turned = {}
    for i in "12":
        x, y = F.col(f"x{i}"), F.col(f"y{i}")
        turned |= {f"x{i}": x * cos - y * sin, f"y{i}": x * sin + y * cos}
    free = free_stretches(shores.withColumns(turned), step_m, key)
    return free.groupBy(key).agg((F.sum(F.col("x_to") - F.col("x_from")) * step_m).alias("area_m2"))


def _traces(r: Column) -> Column:
    """What lies at distance ``r`` from an edge: the two lines beside it (l) and the circles around its ends (c)."""
    x1, y1, x2, y2 = map(F.col, _XY)
    length = F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))
    nx, ny = -(y2 - y1) / length * r, (x2 - x1) / length * r

    def trace(kind, *at):
        return F.struct(F.lit(kind).alias("kind"), *(v.alias(c) for v, c in zip(at, _XY)))

    return F.array(
        trace("l", x1 + nx, y1 + ny, x2 + nx, y2 + ny), trace("l", x1 - nx, y1 - ny, x2 - nx, y2 - ny),
        trace("c", x1, y1, x1, y1), trace("c", x2, y2, x2, y2),
    )


def _meet(r: Column) -> Column:
    """Points (px, py) in which the traces a and b meet; a line comes first."""
    ax, ay, ax2, ay2, bx, by, bx2, by2 = (F.col(s + c) for s in "ab" for c in _XY)
    dx, dy = ax2 - ax, ay2 - ay

    def point(x, y):
        return F.struct(x.alias("px"), y.alias("py"))

    u = F.try_divide((bx - ax) * (by2 - by) - (by - ay) * (bx2 - bx), dx * (by2 - by) - dy * (bx2 - bx))
    length = dx * dx + dy * dy
    t = ((bx - ax) * dx + (by - ay) * dy) / length  # the line's place nearest to the circle's centre
    off = (ax + t * dx - bx) * (ax + t * dx - bx) + (ay + t * dy - by) * (ay + t * dy - by)
    half = F.sqrt((r * r - off) / length)
    gap = (bx - ax) * (bx - ax) + (by - ay) * (by - ay)
    out = F.sqrt(r * r / gap - 0.25)
    line, circle = (F.col("akind") == "l") & (F.col("bkind") == "l"), F.col("akind") == "l"
    return (
        F.when(line, F.array(point(ax + u * dx, ay + u * dy)))
        .when(circle & (off <= r * r), F.array(*(point(ax + (t + s * half) * dx, ay + (t + s * half) * dy) for s in (1.0, -1.0))))
        .when(~circle & (gap > 0) & (gap <= 4 * r * r), F.array(*(
            point((ax + bx) / 2 + s * out * (by - ay), (ay + by) / 2 - s * out * (bx - ax)) for s in (1.0, -1.0))))
    )


def _degrees(x: Column, y: Column) -> Column:
    lon, lat = albers_inverse(x, y)
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def _box(points: DataFrame, key: str) -> DataFrame:
    return points.groupBy(key).agg(
        F.min("p.lon").alias("minx"), F.min("p.lat").alias("miny"), F.max("p.lon").alias("maxx"), F.max("p.lat").alias("maxy")
    )


def inset_boxes(shores: DataFrame, inside, step_m: float = STEP_M, key: str = "lake_id") -> DataFrame:
    """``key, minx, miny, maxx, maxy`` in degrees of what the inset leaves.

    ``inside(points, shores)`` keeps the points (key, px, py) that lie in the lake and no nearer
    to its shores than their ``inset_m``. A millimetre is allowed for rounding.
    """
    free = free_stretches(shores, step_m, key)
    ends = free.select(key, F.explode(F.array(_degrees(F.col("x_from"), F.col("y")), _degrees(F.col("x_to"), F.col("y")))).alias("p"))
    inner = _box(ends, key).withColumnsRenamed({c: f"own_{c}" for c in _BOX})
    # a straight edge bends in degrees, so the stretches' box may reach beyond its ends: by no more than this
    bend = F.greatest(F.col("own_maxx") - F.col("own_minx"), F.col("own_maxy") - F.col("own_miny"))
    slack = bend * bend / 150.0
    inner = materialise(inner.withColumns({
        "minx": F.col("own_minx") + slack, "miny": F.col("own_miny") + slack, "maxx": F.col("own_maxx") - slack, "maxy": F.col("own_maxy") - slack,
    }))
    # edges that a corner beyond this box can belong to: the inset in degrees, generously
    near = shores.select(key, *_XY, "inset_m").join(inner, key)
    spots = [_degrees(F.col(f"x{i}"), F.col(f"y{i}")) for i in (1, 2)]
    margin = F.col("inset_m") / 111_000.0 * 1.1
    wide = margin / F.greatest(F.cos(F.radians(F.greatest(F.abs("miny"), F.abs("maxy")))), F.lit(0.01))
    near = near.withColumns({"a": spots[0], "b": spots[1], "margin": margin, "wide": wide}).where(
        (F.least("a.lon", "b.lon") - F.col("wide") < F.col("minx")) | (F.greatest("a.lon", "b.lon") + F.col("wide") > F.col("maxx"))
        | (F.least("a.lat", "b.lat") - F.col("margin") < F.col("miny")) | (F.greatest("a.lat", "b.lat") + F.col("margin") > F.col("maxy"))
    ).select(key, *_XY, "inset_m", "minx", "miny", "maxx", "maxy")
    cells = materialise(passed_cells(near.withColumn("size", F.col("inset_m") * 4), F.col("inset_m") * 1.01))
    # edges are shuffled, by a count that grows with them; traces are made, freed of copies and met where they are
    tasks = max(int(shores.sparkSession.conf.get("spark.sql.shuffle.partitions")), cells.count() // CELLS_A_TASK)
    dealt = cells.select(key, "cx", "cy", "size", "inset_m", *_BOX, *_XY).repartition(tasks, key, "cx", "cy")
    traced = dealt.select(key, "cx", "cy", "size", "inset_m", *_BOX, F.inline(_traces(F.col("inset_m")))).distinct()
    one, two = (
        traced.select(key, "cx", "cy", *more, *(F.col(c).alias(f"{s}{c}") for c in ("kind", *_XY)))
        for s, more in (("a", ["size", "inset_m", *_BOX]), ("b", []))
    )
    pairs = one.join(two, [key, "cx", "cy"]).where("akind = 'l' OR bkind = 'c'")
    at = pairs.select(key, "cx", "cy", "size", *_BOX, F.inline(_meet(F.col("inset_m")))).where("px IS NOT NULL")
    own = (F.floor(F.col("px") / F.col("size")) == F.col("cx")) & (F.floor(F.col("py") / F.col("size")) == F.col("cy"))
    at = at.where(own).withColumn("p", _degrees(F.col("px"), F.col("py")))
    beyond = (F.col("p.lon") < F.col("minx")) | (F.col("p.lon") > F.col("maxx")) | (F.col("p.lat") < F.col("miny")) | (F.col("p.lat") > F.col("maxy"))
    corners = materialise(at.where(beyond).select(key, "px", "py").distinct())
    kept = inside(corners, shores.withColumn("inset_m", F.col("inset_m") - 1e-3))
    corner_box = _box(kept.select(key, _degrees(F.col("px"), F.col("py")).alias("p")), key)
    return corner_box.select(key, *_BOX)
