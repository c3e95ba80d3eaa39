"""Pixels to lakes, and pixel statistics per lake or per file."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limnia.functions.cleaning import finite
from limnia.functions.geometry import in_box
from limnia.operators.numbering import row_numbers
from limnia.operators.quantiles import _equal, attach, group_stats
from limnia.session import materialise

# Lakes are looked up through grid cells of their own size: the side of a lake's cells is the
# largest power of two, in degrees, that half its box's longer side holds. These are the powers used.
LEVELS = (-10, 9)
# Beyond so many lake cells pixels are shuffled to them; a task then gets about a tenth as many.
BROADCAST_CELLS = 200_000
# Lakes share counts by place if pixels meet more than SHARED times as many lakes as there are pixels and tiles of
# lakes. A lake has a few hundred tiles, down to FINER levels below its own; counts are of WAYS ranges of values at once.
SHARED = 8
TILES_A_LAKE = 300
FINER = 3
WAYS = 32


def _cell_no(c, size):
    return F.floor(F.col(c) / size).cast("bigint")


def _cell_key(level, cx, cy):
    """Level and cell in one number, so that the join hashes a single key; far cells may share one, which the exact test sorts out."""
    wrapped = [F.pmod(c, F.lit(1 << 28)) for c in (cx, cy)]
    return F.shiftleft(level.cast("bigint"), 56) + F.shiftleft(wrapped[0], 28) + wrapped[1]


def _own_level() -> Column:
    """The level of a box's cells, from its bounds."""
    longer = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    # a point has no logarithm and gets the smallest cells
    level = F.coalesce(F.floor(F.log2(F.when(longer > 0, longer / 2))).cast("int"), F.lit(LEVELS[0]))
    return F.greatest(F.lit(LEVELS[0]), F.least(F.lit(LEVELS[1]), level))


def lake_cells(boxes: DataFrame, cell: float | None = None) -> DataFrame:
    """One row per (lake, grid cell its box touches): ``level``, ``side`` and ``cell``, at most 25 of a lake.

    Boxes beyond the largest level (the globe has none) have more. A given ``cell`` is the
    side of the cells of all lakes.
    """
    if cell is None:
        boxes = boxes.withColumn("level", _own_level())
        boxes = boxes.withColumn("side", F.pow(F.lit(2.0), F.col("level")))
    else:
        boxes = boxes.withColumns({"level": F.lit(0), "side": F.lit(float(cell))})
    side = F.col("side")
    wide = boxes.withColumn("cx", F.explode(F.sequence(_cell_no("minx", side), _cell_no("maxx", side))))
    wide = wide.withColumn("cy", F.explode(F.sequence(_cell_no("miny", side), _cell_no("maxy", side))))
    return wide.withColumn("cell", _cell_key(F.col("level"), F.col("cx"), F.col("cy"))).drop("cx", "cy")


def pixels_in_boxes(
    pixels: DataFrame, boxes: DataFrame, cell: float | None = None, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Inner join of pixels to every lake box that holds them (boxes may overlap).

    The range join is an equi-join on level and grid cell plus the exact box test, so it never
    becomes a nested loop. A pixel is looked up once for each level that some lake has (twenty at
    most) and there meets only lakes about as large as the cell, so a thousand ponds in one
    degree don't meet all its pixels. The lake cells are written and counted: the planner
    broadcasts few of them; many are never broadcast, and both sides are shuffled.
    """
    known = materialise(lake_cells(boxes, cell))
    n, cells = known.count(), known.drop("level", "side")
    if cell is None:
        levels = known.agg(F.collect_set(F.struct("level", "side")).alias("levels")).scalar()
        p = pixels.select("*", F.inline(levels).alias("level", "side"))
    else:
        p = pixels.withColumns({"level": F.lit(0), "side": F.lit(float(cell))})
    side = F.col("side")
    p = p.withColumn("cell", _cell_key(F.col("level"), _cell_no(lon, side), _cell_no(lat, side))).drop("level", "side")
    if n > BROADCAST_CELLS:
        # the result is far larger than either side, so the count of tasks is one that adaptive execution keeps
        tasks = max(int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions")), 10 * n // BROADCAST_CELLS)
        p, cells = p.repartition(tasks, "cell"), cells.repartition(tasks, "cell").hint("shuffle_hash")
    joined = p.join(cells, "cell")
    return joined.where(in_box(F.col(lon), F.col(lat), *map(F.col, ("minx", "miny", "maxx", "maxy")))).drop(
        "cell", "minx", "miny", "maxx", "maxy"
    )


def file_lake_rows(files: DataFrame, lakes: DataFrame) -> DataFrame:
    """One row per (file, lake): the row set of the result, which lists lakes without pixels too.

    Files are spread over one axis of a square of slots and copied along the other, lakes
    the other way round, so this is an equi-join in many even pieces whose output is exactly
    the required rows.
    """
    # some pieces for each task of a shuffle
    slots = max(4, math.isqrt(4 * int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))

    def own(df):
        return F.pmod(F.xxhash64(*df.columns), F.lit(slots)).cast("int")

    f = files.withColumn("fs", own(files)).withColumn("ls", every)
    l = lakes.withColumn("ls", own(lakes)).withColumn("fs", every)
    return f.join(l, ["fs", "ls"]).drop("fs", "ls")


def _index_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return group_stats(df, keys, [value], {"CI_p90": (value, 0.9)}, {"n_valid": value}, {"CI_mean": value})


def lake_tiles(boxes: DataFrame) -> DataFrame:
    """Boxes as few tiles that boxes share: ``level``, ``shore``, ``cx``, ``cy`` and the side of a tile.

    Tiles are as large as fit into the box, from its own level down to FINER levels below; what
    is left is covered by ``shore`` tiles of the last level, which lie only partly inside.
    """
    inside, rects = {"x": (F.lit(1), F.lit(0)), "y": (F.lit(1), F.lit(0))}, []
    for k in range(FINER + 1):
        level = F.col("own") - k
        side = F.pow(F.lit(2.0), level)
        touched = {d: (_cell_no(f"min{d}", side), _cell_no(f"max{d}", side)) for d in "xy"}
        # what the level above has covered already, in tiles of this level
        hole = {d: (first * 2, last * 2 + 1) if k else (first, last) for d, (first, last) in inside.items()}
        inside = {d: (F.ceil(F.col(f"min{d}") / side).cast("bigint"), touched[d][1] - 1) for d in "xy"}
        for shore, whole, left_out in ((False, inside, hole), (True, touched, inside)):
            if shore and k < FINER:
                continue
            bounds = [
                at.cast("bigint").alias(f"{name}{d}{i}")
                for name, r in (("r", whole), ("h", left_out)) for d in "xy" for i, at in enumerate(r[d])
            ]
            rects.append(F.struct(level.alias("level"), side.alias("side"), F.lit(shore).alias("shore"), *bounds))
    wide = boxes.withColumn("own", _own_level()).select("*", F.inline(F.array(*rects))).drop("own")
    wide = wide.where((F.col("rx0") <= F.col("rx1")) & (F.col("ry0") <= F.col("ry1")))
    wide = wide.withColumn("cy", F.explode(F.sequence("ry0", "ry1")))
    covered = F.col("cy").between(F.col("hy0"), F.col("hy1"))
    free = F.filter(F.sequence("rx0", "rx1"), lambda c: ~(covered & c.between(F.col("hx0"), F.col("hx1"))))
    return wide.withColumn("cx", F.explode(free)).drop(*[f"{n}{d}{i}" for n in "rh" for d in "xy" for i in (0, 1)])


def _units(boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lakes with their ``unit``, and the units' boxes: lakes of one and the same box are one unit."""
    bounds = ["minx", "miny", "maxx", "maxy"]
    held = boxes.select("lake_id", *bounds).dropna(subset=bounds)
    lakes = held.groupBy("lake_id").agg(F.count("*").alias("n"), *[F.min(c).alias(c) for c in bounds])
    number = F.monotonically_increasing_id()
    one = materialise(lakes.where("n = 1").select(*bounds).distinct().withColumn("unit", number))
    more = materialise(lakes.where("n > 1").select("lake_id", (-1 - number).alias("unit")))
    named = lakes.where("n = 1").join(one, bounds).select("lake_id", "unit").unionByName(more)
    h, m = held.alias("h"), more.alias("m")
    several = h.join(m, _equal(["lake_id"], "h", "m")).select("unit", *[f"h.{c}" for c in bounds])
    return named, one.select("unit", *bounds).unionByName(several)


def _ranges(widths: Sequence[int]) -> Column:
    """First number of the range that a reading's number lies in, after ranges were split into such widths in turn."""
    rest = F.col("at")
    for w in widths:
        rest = rest % w
    return F.col("at") - rest if widths else F.lit(0).cast("bigint")


class _InTiles:
    """Places by longitude and latitude, lakes as boxes, by way of their tiles."""

    place, cells = ["lon", "lat"], ["level", "shore", "cx", "cy", "lon", "lat"]

    def __init__(self, boxes: DataFrame) -> None:
        lakes, unit_boxes = _units(boxes)
        self.lakes, tiles = materialise(lakes), materialise(lake_tiles(unit_boxes))
        self.levels = tiles.agg(F.collect_set(F.struct("level", "side", "shore"))).scalar()
        self.tiles = tiles.drop("side")

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows

    def looked_up(self, places: DataFrame) -> DataFrame:
        """Each place once for each level of tiles; only shore tiles keep where in the tile it lies."""
        out = places.select("*", F.inline(self.levels).alias("level", "side", "shore"))
        out = out.withColumns({"cx": _cell_no("lon", F.col("side")), "cy": _cell_no("lat", F.col("side"))})
        return out.withColumns({c: F.when(F.col("shore"), F.col(c)) for c in ("lon", "lat")}).drop("side")

    def opened(self, readings: DataFrame, parts: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
        """Readings, and the units' tiles with their open ranges (``parts``)."""
        return readings, self.tiles.join(parts, "unit")

    def met(self, rows: DataFrame, tiles: DataFrame, also: list[str]) -> DataFrame:
        """Rows of tiles with the units they lie in; ``also``: what must be equal besides the tile."""
        r, t = rows.alias("r"), tiles.alias("t")
        same = _equal(["level", "shore", "cx", "cy"], "r", "t")
        if also:
            same &= _equal(also, "r", "t")
        near = r.join(t, same).where(~F.col("r.shore") | in_box(F.col("lon"), F.col("lat"), *map(F.col, ("minx", "miny", "maxx", "maxy"))))
        return near.select("unit", "r.*").drop(*self.cells)


class _InRuns:
    """Places by row and pixel, lakes as runs of pixels, by way of their stretches.

    Readings, their counts and the lakes' stretches lie by bands of rows and tiles of a row: what is summed
    up and joined there needs no further shuffle, and a lake's stretches of a band meet before they are shuffled.
    """

    place, cells = ["band", "tile", "y", "x"], ["band", "tile", "y", "level", "stretch"]

    def __init__(self, runs: DataFrame) -> None:
        self.tasks = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.lakes = materialise(runs.select("lake_id").distinct().withColumn("unit", F.monotonically_increasing_id()))
        pieces = stretches(runs.join(self.lakes, "lake_id").select("unit", "y", "x_from", "x_to")).withColumn("band", self.band())
        held = F.collect_list(F.struct("y", "level", "stretch")).alias("pieces")
        self.packed = materialise(pieces.groupBy("unit", "band", "tile").agg(held))
        self.tiles = self._unpacked(self.packed)

    @staticmethod
    def band() -> Column:
        return F.floor(F.col("y") / BAND)

    def dealt(self, rows: DataFrame) -> DataFrame:
        placed = rows.withColumns({"band": self.band(), "tile": F.floor(F.col("x") / (1 << STRETCH))})
        return placed.repartition(self.tasks, "band", "tile")

    def _unpacked(self, packed: DataFrame) -> DataFrame:
        return packed.repartition(self.tasks, "band", "tile").select("*", F.inline("pieces")).drop("pieces")

    def looked_up(self, places: DataFrame) -> DataFrame:
        """Each place once for each length of stretches."""
        levels = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("x", k).alias("stretch")) for k in range(STRETCH + 1)])
        return places.select("*", F.inline(levels)).drop("x")

    def opened(self, readings: DataFrame, parts: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame]:
        """Readings in ranges that are open for a lake of their band and tile, and the units' stretches with their open ranges (``parts``)."""
        at = [*group, "low"]
        parts = parts.groupBy("unit").agg(F.collect_list(F.struct(*at)).alias("parts"))
        packed = materialise(self.packed.join(parts, "unit"))
        here = packed.repartition(self.tasks, "band", "tile").select("band", "tile", F.inline("parts")).distinct()
        r, o = readings.alias("r"), here.hint("shuffle_hash").alias("o")
        return r.join(o, self._same(at, "o"), "left_semi"), self._unpacked(packed).select("*", F.inline("parts")).drop("parts")

    @staticmethod
    def _same(also: list[str], other: str) -> Column:
        same = (F.col("r.band") == F.col(f"{other}.band")) & (F.col("r.tile") == F.col(f"{other}.tile"))
        return same & _equal(also, "r", other) if also else same

    def met(self, rows: DataFrame, tiles: DataFrame, also: list[str]) -> DataFrame:
        """Rows of stretches with the units that have these; ``also``: what must be equal besides the stretch."""
        r, t = rows.alias("r"), tiles.alias("t")
        return r.join(t, self._same(["y", "level", "stretch", *also], "t")).select("unit", "r.*").drop(*self.cells)


def _shared_stats(pixels: DataFrame, boxes: DataFrame, keys: Sequence[str], value: str, p: float = 0.9) -> DataFrame:
    """Mean, exact quantile and valid count per (file, lake) where lakes are boxes that lie on each other."""
    named = {f"g{i}": key for i, key in enumerate(keys)}
    # read several times, so that cleaning is done once
    rows = materialise(pixels.select(
        *[F.col(f"`{key}`").alias(g) for g, key in named.items()],
        *[finite(F.col(c).cast("double")).alias(c) for c in ("lon", "lat")], finite(F.col(value)).alias("v"),
    ).dropna(subset=["lon", "lat"])).withColumn("v", F.col("v").cast("double"))
    return _counted_stats(rows, named, _InTiles(boxes), p)


def run_stats(pixels: DataFrame, runs: DataFrame, keys: Sequence[str], value: str, p: float = 0.9) -> DataFrame:
    """Mean, exact quantile and valid count per (file, lake) of pixels (y, x) in the lakes' runs (``lake_id, y, x_from, x_to``).

    Lakes on each other share counts by place: a lake meets a few stretches for each of its rows,
    and not each reading of each pixel.
    """
    named = {f"g{i}": key for i, key in enumerate(keys)}
    # what is shuffled for a table is deleted once that is written
    with _joined_in_place(pixels.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        rows = materialise(pixels.select(
            *[F.col(f"`{key}`").alias(g) for g, key in named.items()],
            F.col("y").cast("bigint").alias("y"), F.col("x").cast("bigint").alias("x"), finite(F.col(value)).alias("v"),
        ).dropna(subset=["y", "x"])).withColumn("v", F.col("v").cast("double"))
        return materialise(_counted_stats(rows, named, _InRuns(runs), p))


def _counted_stats(rows: DataFrame, named: dict[str, str], lakes_at: _InTiles | _InRuns, p: float) -> DataFrame:
    """Mean, exact quantile and valid count per (file, lake) where lakes lie on each other.

    ``rows``: the files' columns under their working names, a place and the reading ``v``.

    Readings are numbered in the order of their values. Counts of WAYS ranges of numbers are made
    for each place, then for tiles (or stretches) of places, and a lake adds up the counts of its few hundred
    tiles: they tell in which range its wanted ranks lie. These ranges are split in the
    same way, until the lakes' readings in them are no more than there are readings in all; those
    are looked up one by one. No lake meets all its readings.
    """
    group, place, spots = list(named), lakes_at.place, [c for c in rows.columns if c not in named and c != "v"]
    readings = row_numbers(rows.where("v IS NOT NULL"), ["v"], name="at")
    n = readings.count()
    counts = [f"c{i}" for i in range(WAYS)]

    def counted(near: DataFrame, widths: list[int]) -> DataFrame:
        """Places with the counts of the ranges into which the last width splits the ranges of those before."""
        low, own = _ranges(widths[:-1]), F.floor((_ranges(widths) - _ranges(widths[:-1])) / widths[-1])
        return near.withColumns({"low": low, "own": own}).groupBy(*group, "low", *place).agg(
            *[F.count_if(F.col("own") == i).alias(c) for i, c in enumerate(counts)], F.sum("v").alias("s"))

    def added(places: DataFrame, near: DataFrame, also: list[str]) -> DataFrame:
        """Units with the counts of their ranges."""
        sums = [F.sum(c).alias(c) for c in (*counts, "s")]
        shared = lakes_at.looked_up(places).groupBy(*group, "low", *lakes_at.cells).agg(*sums)
        return lakes_at.met(shared, near, also).groupBy("unit", *group, "low").agg(*sums)

    def opened(goals: DataFrame, width: int) -> DataFrame:
        """Goals (``t``; rank ``k`` in the range) with the part of their range that holds them, and its readings ``n``."""
        def step(a, c):
            upto = a["upto"] + c
            return F.struct((a["i"] + F.when(upto <= F.col("k"), 1).otherwise(0)).alias("i"),
                            F.when(upto <= F.col("k"), upto).otherwise(a["before"]).alias("before"), upto.alias("upto"))

        zero = F.lit(0).cast("bigint")
        start = F.struct(zero.alias("i"), zero.alias("before"), zero.alias("upto"))
        at = goals.withColumn("c", F.array(*counts)).withColumn("f", F.aggregate("c", start, step))
        return materialise(at.select(
            "unit", *group, "t", (F.col("low") + F.col("f.i") * width).alias("low"), (F.col("k") - F.col("f.before")).alias("k"),
            F.element_at("c", (F.col("f.i") + 1).cast("int")).alias("n"),
        ))

    widths, at = [max(1, -(-n // WAYS))], ["unit", *group, "low"]
    # places without any valid reading give their lakes a row, too
    bare = rows.where("v IS NULL").select(*group, *spots).distinct().withColumns(
        {"at": F.lit(None).cast("bigint"), "v": F.lit(None).cast("double")})
    first = materialise(added(counted(lakes_at.dealt(readings.unionByName(bare)), widths), lakes_at.tiles, []))
    total = sum((F.col(c) for c in counts[1:]), F.col(counts[0]))
    first = first.withColumn("total", total)
    pos = F.lit(float(p)) * (F.col("total") - 1)
    ranks = F.array(*[F.struct(F.lit(t).alias("t"), k.cast("bigint").alias("k")) for t, k in enumerate((F.floor(pos), F.ceil(pos)))])
    goals = opened(first.where("total > 0").select("*", F.inline(ranks)), widths[-1])

    def near_goals() -> tuple[DataFrame, DataFrame]:
        """Readings in ranges that are open for some unit, and the units' tiles with their open ranges."""
        # written, so that the planner sees how few ranges they are
        lows = materialise(goals.select("low").distinct())
        some = readings.withColumn("low", _ranges(widths)).join(lows, "low", "left_semi")
        return lakes_at.opened(lakes_at.dealt(some), goals.select(*at).distinct(), group)

    while widths[-1] > 1 and goals.groupBy(*at).agg(F.max("n").alias("n")).agg(F.sum("n")).first()[0] > n:
        some, near = near_goals()
        widths.append(-(-widths[-1] // WAYS))
        split = added(counted(some.drop("low"), widths), near, [*group, "low"])
        g, c = goals.drop("n").alias("g"), split.alias("c")
        goals = opened(g.join(c, _equal(at, "g", "c")).select("g.*", *counts), widths[-1])

    some, near = near_goals()
    found = lakes_at.met(lakes_at.looked_up(some), near, [*group, "low"])
    found = found.withColumn("k", F.row_number().over(Window.partitionBy(*at).orderBy("at")).cast("bigint") - 1)
    f, g = found.alias("f"), goals.alias("g")
    found = f.join(g, _equal([*at, "k"], "f", "g")).groupBy(*[F.col(f"g.{c}").alias(c) for c in ("unit", *group)]).agg(
        *[F.max(F.when(F.col("t") == t, F.col("v"))).alias(f"v{t}") for t in (0, 1)])
    frac = pos - F.floor(pos)
    stats = attach(first.select("unit", *group, "s", "total"), found, ["unit", *group])
    return stats.join(lakes_at.lakes, "unit").select(
        *[F.col(g).alias(key) for g, key in named.items()], "lake_id", F.try_divide("s", "total").alias("CI_mean"),
        F.col("total").alias("n_valid"), (F.col("v0") * (1 - frac) + F.col("v1") * frac).alias("CI_p90"),
    )


def with_blank(stats: DataFrame, blank: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Shared statistics, and a row without a valid pixel for each of the ``blank`` keys that has none yet."""
    if blank is not None:
        stats = stats.unionByName(blank, allowMissingColumns=True)
    return stats.groupBy(*keys).agg(
        F.max("CI_mean").alias("CI_mean"), F.coalesce(F.max("n_valid"), F.lit(0)).alias("n_valid"), F.max("CI_p90").alias("CI_p90")
    )


def _crowded(pixels: DataFrame, boxes: DataFrame, file_cols: Sequence[str]) -> bool:
    """Do readings and lakes meet far more often than there are readings, and tiles of lakes in all files?"""
    if boxes.limit(SHARED + 1).count() <= SHARED:
        return False
    cells = materialise(lake_cells(boxes))
    levels = cells.agg(F.collect_set(F.struct("level", "side"))).scalar()
    looked = pixels.select("lon", "lat", F.inline(levels).alias("level", "side"))
    looked = looked.select(_cell_key(F.col("level"), _cell_no("lon", F.col("side")), _cell_no("lat", F.col("side"))).alias("cell"))
    per_cell = looked.groupBy("cell").agg(F.count("*").alias("n")).join(cells.groupBy("cell").agg(F.count("*").alias("lakes")), "cell")
    pairs = per_cell.agg(F.sum(F.col("n") * F.col("lakes"))).first()[0] or 0
    n, files = pixels.agg(F.count("*"), F.approx_count_distinct(F.struct(*file_cols))).first()
    return pairs > SHARED * (n + TILES_A_LAKE * boxes.count() * files)


def zonal_stats(
    pixels: DataFrame, boxes: DataFrame, value: str, file_cols: Sequence[str] = ("src", "date"),
    files: DataFrame | None = None, keep_empty: bool = True, cell: float | None = None,
) -> DataFrame:
    """Mean, exact 90th percentile and valid count per (file, lake).

    Where readings lie in many lakes, lakes share counts by place (:func:`_shared_stats`) and don't
    meet each of their readings; the result is the same.

    With ``keep_empty`` every file lists every lake, those without a valid pixel as
    NULL, NULL, 0. The empty rows enter the same aggregation as the pixels, as rows without
    a value, so they cost no join of their own. That is files x lakes rows: leave it out where
    lakes are many.
    """
    keys = [*file_cols, "lake_id"]
    if keep_empty:
        if files is None:
            files = pixels.select(*file_cols).distinct()
        blank = file_lake_rows(files.select(*file_cols), boxes.select("lake_id"))
    if cell is None and _crowded(pixels, boxes, file_cols):
        stats = _shared_stats(pixels, boxes, file_cols, value)
        return with_blank(stats, blank if keep_empty else None, keys)
    hits = pixels_in_boxes(pixels, boxes, cell).select(*keys, value)
    if keep_empty:
        hits = hits.unionByName(blank.withColumn(value, F.lit(None).cast(dict(pixels.dtypes)[value])))
    return _index_stats(hits, keys, value)


def regional_stats(
    pixels: DataFrame, value: str, file_cols: Sequence[str] = ("src", "date")
) -> DataFrame:
    """Mean, exact 90th percentile and valid count per file, over all its pixels."""
    return _index_stats(pixels, list(file_cols), value)


# Runs are looked up through tiles of so many pixels of a row.
TILE = 1024
# Sums that lakes share are made for stretches of up to 2**STRETCH pixels of a row, if pixels lie in more than SHARED lakes.
STRETCH = 8
# Counts that lakes share lie by bands of so many rows.
BAND = 8


def row_runs(members: DataFrame) -> DataFrame:
    """Member pixels (y, x and the lake's columns) as runs of neighbours in a row: ``y, x_from, x_to``.

    A lake's shore cuts a row of the grid a few times, so a lake of n pixels has about as many
    runs as rows, and not n. Numbering looks at one row of one lake at a time.
    """
    lake = [c for c in members.columns if c not in ("y", "x")]
    place = F.row_number().over(Window.partitionBy(*lake, "y").orderBy("x"))
    return members.withColumn("run", F.col("x") - place).groupBy(*lake, "y", "run").agg(
        F.min("x").alias("x_from"), F.max("x").alias("x_to")
    ).drop("run")


def in_runs(pixels: DataFrame, runs: DataFrame) -> DataFrame:
    """Inner join of pixels (y, x) to every run that holds them; the lake's columns come along.

    An equi-join on row and tile with a range test: a run is listed in each tile it reaches. The
    planner broadcasts the runs if their size allows it.
    """
    number = lambda c: F.floor(F.col(c) / TILE).cast("int")
    tiled = runs.withColumn("tile", F.explode(F.sequence(number("x_from"), number("x_to"))))
    met = pixels.withColumn("tile", number("x")).join(tiled, ["y", "tile"])
    return met.where(F.col("x").between(F.col("x_from"), F.col("x_to"))).drop("tile", "x_from", "x_to")


def stretches(runs: DataFrame) -> DataFrame:
    """Runs as aligned stretches of 1, 2, 4, ... pixels of a row, up to ``2**STRETCH``: ``tile, level, stretch``.

    A run has two stretches of a level at most, as few as cover it; each pixel of it lies in just one.
    """
    wide, x_from, x_to = 1 << STRETCH, F.col("x_from").cast("bigint"), F.col("x_to").cast("bigint")
    tiled = runs.withColumn("tile", F.explode(F.sequence(F.floor(x_from / wide), F.floor(x_to / wide))))
    start, end = F.greatest(x_from, F.col("tile") * wide), F.least(x_to + 1, (F.col("tile") + 1) * wide)
    pieces = []
    for level in range(STRETCH + 1):
        first, stop = F.ceil(start / (1 << level)), F.floor(end / (1 << level))
        at_start = (first < stop) & ((first % 2 != 0) | F.lit(level == STRETCH))
        at_end = (first < stop) & (stop % 2 != 0) & F.lit(level < STRETCH)
        pieces += [
            F.when(here, F.struct(F.lit(level).alias("level"), at.alias("stretch")))
            for here, at in ((at_start, first), (at_end, stop - 1))
        ]
    found = F.filter(F.array(*pieces), lambda p: p.isNotNull())
    return tiled.select("*", F.inline(found)).drop("x_from", "x_to")


@contextlib.contextmanager
def _joined_in_place(spark: SparkSession, **more: str):
    """Joins planned within don't shuffle tables again that already lie by some of the join's keys; ``more`` settings by name, __ for dots."""
    settings = {"spark.sql.requireAllClusterKeysForCoPartition": "false", **{k.replace("__", "."): v for k, v in more.items()}}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, to in settings.items():
        spark.conf.set(name, to)
    try:
        yield
    finally:
        for name, was in before.items():
            spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def overlap(runs: DataFrame) -> float:
    """In how many lakes a pixel lies that lies in any, in the mean."""
    before = Window.partitionBy("y").orderBy("x_from", "x_to").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("x_to").over(before), F.col("x_from") - 1)
    fresh = F.greatest(F.lit(0), F.col("x_to") - F.greatest(reached, F.col("x_from") - 1))
    rows = runs.groupBy("y", "x_from", "x_to").agg(F.count("*").alias("lakes")).withColumn("fresh", fresh)
    size = (F.col("x_to") - F.col("x_from") + 1).cast("bigint")
    sums = rows.agg(F.sum(size * F.col("lakes")).alias("all"), F.sum("fresh").alias("covered")).first()
    return sums["all"] / sums["covered"] if sums["covered"] else 0.0


def member_means(
    cube: DataFrame, members: DataFrame, keys: Sequence[str], variables: Sequence[str],
    lake_cols: Sequence[str] = ("lake_id", "lake_name"), name: str = "var", value: str = "value",
) -> DataFrame:
    """Spatial mean of each variable over the member pixels, one column per variable.

    ``cube`` holds long pixel rows (y, x, var, value). All variables are averaged in one
    pass over the cube with one shuffle of partial sums; a step without any valid pixel
    stays, as NULL. ``members`` is (lake, y, x_from, x_to), as :func:`row_runs` makes it.

    Where a pixel lies in more than SHARED lakes in the mean, the cube is shuffled by place and
    summed by stretches of a row first, which lakes share: a lake then meets a few stretches for
    each of its rows, and not each reading of each pixel.
    """
    sums, counts = [f"_s{i}" for i in range(len(variables))], [f"_n{i}" for i in range(len(variables))]
    own = [F.when(F.col(name) == v, F.col(value).cast("double")) for v in variables]
    if overlap(members) <= SHARED:
        return in_runs(cube, members).groupBy(*lake_cols, *keys).agg(*[F.avg(x).alias(v) for x, v in zip(own, variables, strict=True)])

    add = [F.sum(c).alias(c) for c in (*sums, *counts)]
    # both sides lie by row and tile: the sums and the join need no further shuffle, and a lake's stretches of a row meet
    tasks = int(cube.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cube.withColumn("tile", F.floor(F.col("x") / (1 << STRETCH))).repartition(tasks, "y", "tile")
    cells = cells.groupBy("y", "tile", F.col("x").cast("bigint").alias("x"), *keys).agg(
        *[F.sum(x).alias(c) for x, c in zip(own, sums, strict=True)], *[F.count(x).alias(c) for x, c in zip(own, counts, strict=True)]
    )
    levels = F.array(*[
        F.struct(F.lit(k).alias("level"), F.shiftright("x", k).alias("stretch")) for k in range(STRETCH + 1)
    ])
    shared = cells.select("*", F.inline(levels)).groupBy("y", "tile", "level", "stretch", *keys).agg(*add)
    pieces = stretches(members).repartition(tasks, "y", "tile")
    met = shared.join(pieces.hint("shuffle_hash"), ["y", "tile", "level", "stretch"]).groupBy(*lake_cols, *keys).agg(*add)
    with _joined_in_place(cube.sparkSession):
        met = materialise(met)
    return met.select(*lake_cols, *keys, *[
        F.try_divide(s, n).alias(v) for s, n, v in zip(sums, counts, variables, strict=True)
    ])
