"""Union of polygon parts as an edge table: the outline that dissolving a lake's parts leaves.

Edges are cut where they meet edges of other parts of their lake (crossings, ends that lie on
them, shared stretches). Every piece, taken once, then has each part on both, one or neither of
its sides. It is outline if exactly one side lies in some part; pieces inside the union or
between two parts go.

Both steps are joins: cuts through the grid cells an edge passes, sides through horizontal
bands. Cells and bands are as large as a lake's edges are in the mean, so an edge meets the few
next to it, whatever the size of lake or edges, and the number of cells is linear in edges.
Parts that lie on each other by the thousand would meet each other all the same; lakes of many
parts are united in lots of neighbours, and what lots leave again, until one lot is left.
Lakes of one part have nothing to cut and skip all of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnia.functions.geometry import ray_hits, segment_distance_sq
from limnia.operators.numbering import row_numbers
from limnia.session import materialise

_XY = ("x1", "y1", "x2", "y2")
# Ends of edges that are closer than this are one point, relative to the size of coordinates.
NEAR = 1e-10
# Ends are compared on a grid of so many decimals; what comes out has the given ends again.
PLACES = 9
# So many parts of a lake are united at once.
LOT = 16


def _tolerance(*xy: Column) -> Column:
    return F.greatest(F.lit(1.0), *map(F.abs, xy)) * NEAR


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _lengths(edges: DataFrame, key: str) -> DataFrame:
    """Per lake the cell size: twice an edge's mean extent."""
    size = F.avg(F.abs(F.col("x2") - F.col("x1")) + F.abs(F.col("y2") - F.col("y1"))) * 2
    return edges.groupBy(key).agg(size.alias("size"))


def passed_cells(edges: DataFrame, pad: Column | None = None) -> DataFrame:
    """One row for each cell (cx, cy) of the lake's grid within ``pad`` of an edge; ``size`` is a column."""
    x1, y1, x2, y2 = map(F.col, _XY)
    pad = _tolerance(x1, y1, x2, y2) * 4 if pad is None else pad

    def number(v):
        return F.floor(v / F.col("size")).cast("bigint")

    rows = edges.withColumn("cy", F.explode(F.sequence(number(F.least(y1, y2) - pad), number(F.greatest(y1, y2) + pad))))
    # the stretch of the edge within the row's height, and the columns of cells it passes
    slope = F.coalesce(F.try_divide(x2 - x1, y2 - y1), F.lit(0.0))
    low = F.greatest(F.least(y1, y2), F.col("cy") * F.col("size") - pad)
    high = F.least(F.greatest(y1, y2), (F.col("cy") + 1) * F.col("size") + pad)
    ends = [x1 + (low - y1) * slope, x1 + (high - y1) * slope]
    flat = F.abs(y2 - y1) <= pad
    left = F.when(flat, F.least(x1, x2)).otherwise(F.greatest(F.least(x1, x2), F.least(*ends)))
    right = F.when(flat, F.greatest(x1, x2)).otherwise(F.least(F.greatest(x1, x2), F.greatest(*ends)))
    return rows.withColumn("cx", F.explode(F.sequence(number(left - pad), number(F.greatest(left, right) + pad))))


def _snapped(edges: DataFrame, key: str) -> DataFrame:
    """A part's own edges once each, their ends on a grid; what a part has twice cancels out."""
    e = edges.select(key, "part", *(F.round(c, PLACES).alias(c) for c in _XY)).where("x1 <> x2 OR y1 <> y2")
    turn = (F.col("x1") > F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") > F.col("y2")))
    swapped = {a: F.when(turn, F.col(b)).otherwise(F.col(a)) for a, b in zip(_XY, ("x2", "y2", "x1", "y1"))}
    return e.withColumns(swapped).groupBy(key, "part", *_XY).agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")


def _meetings(edges: DataFrame, key: str) -> DataFrame:
    """Edge and point: where an edge is met by an edge of another part of its lake."""
    cells = materialise(passed_cells(edges.join(_lengths(edges, key), key)))
    a = cells.select(key, "cx", "cy", F.col("part").alias("pa"), *(F.col(c).alias(f"a{c}") for c in _XY))
    b = cells.select(key, "cx", "cy", F.col("part").alias("pb"), *(F.col(c).alias(f"b{c}") for c in _XY))
    ax1, ay1, ax2, ay2, bx1, by1, bx2, by2 = (F.col(s + c) for s in "ab" for c in _XY)
    tol = _tolerance(*(F.col(s + c) for s in "ab" for c in _XY))
    near = (
        (F.least(ax1, ax2) - tol <= F.greatest(bx1, bx2)) & (F.least(bx1, bx2) - tol <= F.greatest(ax1, ax2))
        & (F.least(ay1, ay2) - tol <= F.greatest(by1, by2)) & (F.least(by1, by2) - tol <= F.greatest(ay1, ay2))
    )
    pairs = a.join(b, [key, "cx", "cy"]).where((F.col("pa") < F.col("pb")) & near)

    def on(px, py, x1, y1, x2, y2):
        return segment_distance_sq(px, py, x1, y1, x2, y2) <= tol * tol

    on_a = [on(bx1, by1, ax1, ay1, ax2, ay2), on(bx2, by2, ax1, ay1, ax2, ay2)]
    on_b = [on(ax1, ay1, bx1, by1, bx2, by2), on(ax2, ay2, bx1, by1, bx2, by2)]
    across = (ax2 - ax1) * (by2 - by1) - (ay2 - ay1) * (bx2 - bx1)
    t = F.try_divide((bx1 - ax1) * (by2 - by1) - (by1 - ay1) * (bx2 - bx1), across)
    u = F.try_divide((bx1 - ax1) * (ay2 - ay1) - (by1 - ay1) * (ax2 - ax1), across)
    proper = t.between(0, 1) & u.between(0, 1)
    for end in (*on_a, *on_b):
        proper &= ~end
    # one point for both edges, so that their pieces have equal ends
    crossing = F.when(proper, _point(F.round(ax1 + t * (ax2 - ax1), PLACES), F.round(ay1 + t * (ay2 - ay1), PLACES)))
    met_a = F.array(F.when(on_a[0], _point(bx1, by1)), F.when(on_a[1], _point(bx2, by2)), crossing)
    met_b = F.array(F.when(on_b[0], _point(ax1, ay1)), F.when(on_b[1], _point(ax2, ay2)), crossing)
    sides = F.array(
        F.struct(F.col("pa").alias("part"), *(F.col(f"a{c}").alias(c) for c in _XY), met_a.alias("at")),
        F.struct(F.col("pb").alias("part"), *(F.col(f"b{c}").alias(c) for c in _XY), met_b.alias("at")),
    )
    each = pairs.select(key, F.explode(sides).alias("s")).select(key, "s.part", *(f"s.{c}" for c in _XY), F.explode("s.at").alias("at"))
    return each.where("at IS NOT NULL")


def pieces(edges: DataFrame, key: str = "lake_id") -> DataFrame:
    """A lake's edges cut at all meetings: key, x1, y1, x2, y2 (ends in order) and ``parts``, the parts that have the piece."""
    own = materialise(_snapped(edges, key))
    ends = own.select(key, "part", *_XY, F.lit(None).cast("struct<x:double,y:double>").alias("at"))
    cut = ends.unionByName(_meetings(own, key)).groupBy(key, "part", *_XY).agg(F.collect_set("at").alias("at"))
    x1, y1, x2, y2 = map(F.col, _XY)

    def along(p):
        return (p["x"] - x1) * (x2 - x1) + (p["y"] - y1) * (y2 - y1)

    stops = F.transform(F.col("at"), lambda p: F.struct(along(p).alias("d"), p["x"].alias("x"), p["y"].alias("y")))
    stops = F.concat(stops, F.array(*(
        F.struct(along({"x": x, "y": y}).alias("d"), x.alias("x"), y.alias("y")) for x, y in ((x1, y1), (x2, y2))
    )))
    line = cut.withColumn("s", F.array_sort(F.array_distinct(stops)))
    steps = F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.struct(F.col("s")[i - 1].alias("a"), F.col("s")[i].alias("b")))
    each = line.select(key, "part", F.explode(steps).alias("e")).where("e.a.x <> e.b.x OR e.a.y <> e.b.y")
    # cut points may bend an edge a little, so ends are put in order again
    turn = (F.col("e.a.x") > F.col("e.b.x")) | ((F.col("e.a.x") == F.col("e.b.x")) & (F.col("e.a.y") > F.col("e.b.y")))
    ends = {c: F.when(turn, F.col(q)).otherwise(F.col(p)) for c, p, q in zip(
        _XY, ("e.a.x", "e.a.y", "e.b.x", "e.b.y"), ("e.b.x", "e.b.y", "e.a.x", "e.a.y"))}
    once = each.select(key, "part", *(v.alias(c) for c, v in ends.items())).groupBy(key, *_XY, "part").agg(F.count("*").alias("n"))
    return once.where("n % 2 = 1").groupBy(key, *_XY).agg(F.collect_set("part").alias("parts"))


def _place(parts: DataFrame, key: str) -> DataFrame:
    """key, part and ``place``: parts of a lake numbered along a Z-shaped curve through the middles of their boxes."""
    mx, my = (F.min(F.least(f"{c}1", f"{c}2")) + F.max(F.greatest(f"{c}1", f"{c}2")) for c in "xy")
    spots = materialise(parts.where("part IS NOT NULL").groupBy(key, "part").agg(mx.alias("mx"), my.alias("my")))
    frame = spots.groupBy(key).agg(*(f(c).alias(f"{n}_{c}") for c in ("mx", "my") for n, f in (("low", F.min), ("high", F.max))))

    def spread(c):  # 16 bits of the place in the lake's frame, a gap after each
        share = F.coalesce(F.try_divide(F.col(c) - F.col(f"low_{c}"), F.col(f"high_{c}") - F.col(f"low_{c}")), F.lit(0.0))
        at = F.floor(share * 65_535).cast("bigint")
        return sum((F.shiftleft(F.shiftright(at, i).bitwiseAND(F.lit(1)), 2 * i) for i in range(1, 16)), at.bitwiseAND(F.lit(1)))

    coded = spots.join(frame, key).select(key, "part", (spread("mx") + spread("my") * 2).alias("z"))
    return row_numbers(coded, ["z"], [key]).select(key, "part", "place")


def gathered(edges: DataFrame, key: str = "lake_id") -> DataFrame:
    """Edges of at most ``LOT`` parts for each lake, with the union that all its parts have.

    Lakes of no more parts stay as they are. A round leaves one part of each ``LOT`` neighbours, and
    only edges around it: what lies inside others is gone before it can meet more of them.
    """
    while True:
        n = edges.groupBy(key).agg(F.count_distinct("part").alias("n")).where(F.col("n") > LOT)
        if n.isEmpty():
            return edges
        many = materialise(n.select(key))
        placed = edges.select(key, "part", *_XY).join(_place(edges, key), [key, "part"]).drop("part")
        few = placed.join(many, key, "left_anti").select(key, F.col("place").alias("part"), *_XY)
        lots = placed.join(many, key, "left_semi").withColumn("lot", F.struct(F.col(key).alias("k"), F.floor(F.col("place") / LOT).alias("no")))
        united = _united(lots.select("lot", F.col("place").alias("part"), *_XY), "lot")
        edges = materialise(few.unionByName(united.select(F.col("lot.k").alias(key), F.col("lot.no").alias("part"), *_XY)))


def union_outline(edges: DataFrame, key: str = "lake_id") -> DataFrame:
    """Edges key, x1, y1, x2, y2 around the union of each lake's parts, the lake on their left.

    ``edges`` has key, part and the ends of each ring segment; a part is what its rings enclose
    an odd number of times. Points where parts meet stay as ends of edges. Rows of a part that
    is listed twice under one number cancel out; under two numbers they are united.
    """
    return _united(gathered(edges, key), key)


def _united(edges: DataFrame, key: str) -> DataFrame:
    """The outline of parts that all meet at once."""
    cut = materialise(pieces(edges, key))
    # written with its size, so that both sides of the join below compute the same bands
    sized = materialise(cut.join(_lengths(cut, key), key))
    # the probe of a piece is its middle, a hair above if the piece is level
    mid = sized.select(
        key, *_XY, ((F.col("x1") + F.col("x2")) / 2).alias("px"), ((F.col("y1") + F.col("y2")) / 2).alias("py"), "size"
    ).withColumn("band", F.floor(F.col("py") / F.col("size")).cast("bigint"))
    low, high = (F.floor(f("y1", "y2") / F.col("size")).cast("bigint") for f in (F.least, F.greatest))
    walls = sized.where("y1 <> y2").select(
        key, F.col("parts").alias("wparts"), *(F.col(c).alias(f"w{c}") for c in _XY), F.explode(F.sequence(low, high)).alias("band")
    )
    px, py = F.col("px"), F.col("py")
    itself = (F.col("wx1") == F.col("x1")) & (F.col("wy1") == F.col("y1")) & (F.col("wx2") == F.col("x2")) & (F.col("wy2") == F.col("y2"))
    hit = ray_hits(px, py, *(F.col(f"w{c}") for c in _XY)) & ~itself
    met = mid.join(walls, [key, "band"]).where((F.greatest("wx1", "wx2") >= px) & hit)
    crossed = met.select(key, *_XY, F.explode("wparts").alias("part")).groupBy(key, *_XY, "part").agg(
        F.count("*").alias("n")
    )
    odd = crossed.where("n % 2 = 1").groupBy(key, *_XY).agg(F.collect_set("part").alias("right"))
    both = cut.join(odd, [key, *_XY], "left").withColumn("right", F.coalesce("right", F.array().cast(dict(cut.dtypes)["parts"])))
    # beyond the piece, the parts that have it are left or entered
    other = F.concat(F.array_except("right", "parts"), F.array_except("parts", "right"))
    sided = both.withColumns({"in_right": F.size("right") > 0, "in_left": F.size(other) > 0}).where("in_right <> in_left")
    # 'right' is the side of larger x, or above a level piece; ends are in order of x, then y
    level = F.col("y1") == F.col("y2")
    rising = F.col("y1") < F.col("y2")
    # walking from end 1 to end 2, the left hand is above a level piece and towards smaller x on a rising one
    ahead = F.when(level | ~rising, F.col("in_right")).otherwise(F.col("in_left"))
    turned = {a: F.when(ahead, F.col(a)).otherwise(F.col(b)) for a, b in zip(_XY, ("x2", "y2", "x1", "y1"))}
    return _given(sided.select(key, *(turned[c].alias(c) for c in _XY)), edges, key)


def _given(outline: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """The outline with the ends that the edges had before they were put on the grid."""
    ends = edges.select(key, F.explode(F.array(_point(F.col("x1"), F.col("y1")), _point(F.col("x2"), F.col("y2")))).alias("own"))
    at = [F.round(f"own.{c}", PLACES) for c in "xy"]
    own = ends.groupBy(key, at[0].alias("sx"), at[1].alias("sy")).agg(F.min("own").alias("own"))
    out = outline
    for x, y in (("x1", "y1"), ("x2", "y2")):
        found = own.withColumnsRenamed({"sx": x, "sy": y, "own": f"own_{x}"})
        out = out.join(found, [key, x, y], "left")
    return out.select(key, *(F.coalesce(f"own_{c.replace('y', 'x')}.{c[0]}", c).alias(c) for c in _XY))


def several_parts(table: DataFrame, key: str = "lake_id") -> DataFrame | None:
    """Keys with more than one part, or None if there is none; asks the table once."""
    many = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct("part").alias("n")).where("n > 1").select(key)
    many = materialise(many)
    return None if many.isEmpty() else many


def outlines(edges: DataFrame, many: DataFrame | None, key: str = "lake_id") -> DataFrame:
    """Edges key, x1, y1, x2, y2 around every lake: its rings, or the union of its parts where it has several.

    Other columns are the lake's and stay; ``many`` comes from ``several_parts``.
    """
    more = [c for c in edges.columns if c not in (key, "part", "ring", *_XY)]
    if many is None:
        return edges.select(key, *_XY, *more)
    parted = edges.join(many, key, "left_semi")
    united = union_outline(parted, key)
    if more:
        united = united.join(parted.groupBy(key).agg(*(F.first(c).alias(c) for c in more)), key)
    return edges.join(many, key, "left_anti").select(key, *_XY, *more).unionByName(united)
