"""Regular calendars, gap filling, clipping and rolling means per series.

Series that went through :func:`first_per_period` have at most one row per calendar step, so
one series fits a window partition however many raw rows it came from: the raw rows are
reduced first, with map-side combine. Row windows over tables without that guarantee go
through :func:`centred_mean`, which cuts long series into blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.functions.flags import CLIP_HIGH, CLIP_LOW, clamp
from limnia.functions.timelabel import period_start
from limnia.operators.quantiles import attach, group_stats


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by the given order; missing order values go last.

    A ``min_by`` aggregate: it combines before the shuffle, so a hot key costs no more than
    the others, and the choice does not depend on row placement.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("r")).select(*keys, "r.*")


def first_per_period(
    df: DataFrame, series: Sequence[str], freq: str, time: str = "date", tie: Sequence[str] = ()
) -> DataFrame:
    """Snap ``time`` to its period and keep the earliest raw row of each period."""
    raw = df.withColumns({"raw_time": F.col(time), time: period_start(time, freq)})
    return first_per_key(raw, [*series, time], ["raw_time", *tie]).drop("raw_time")


def _step(freq: str) -> tuple[Column, str]:
    if freq.upper() == "D":
        return F.expr("INTERVAL 1 DAY"), "date_sub(nxt, 1)"
    if freq.upper() in ("M", "MS"):
        return F.expr("INTERVAL 1 MONTH"), "add_months(nxt, -1)"
    if freq.upper() == "W":
        return F.expr("INTERVAL 7 DAY"), "date_sub(nxt, 7)"
    raise ValueError(f"no calendar for {freq!r}")


def calendar_spine(df: DataFrame, series: Sequence[str], freq: str, time: str = "date") -> DataFrame:
    """Every period between each series' first and last one."""
    step, _ = _step(freq)
    span = df.groupBy(*series).agg(F.min(time).alias("a"), F.max(time).alias("b"))
    return span.select(*series, F.explode(F.sequence("a", "b", step)).alias(time))


def fill_calendar(df: DataFrame, series: Sequence[str], freq: str, time: str = "date") -> DataFrame:
    """Insert the missing periods as rows that are NULL in every other column.

    Equal to joining the series onto :func:`calendar_spine`, without the join: each row
    generates the empty periods up to the next row of its series.
    """
    step, before_next = _step(freq)
    w = Window.partitionBy(*series).orderBy(time)
    rest = [c for c in df.columns if c not in (*series, time)]
    spread = df.withColumn("nxt", F.lead(time).over(w)).withColumn(
        "d", F.explode(F.sequence(F.col(time), F.coalesce(F.expr(before_next), F.col(time)), step))
    )
    own = F.col("d") == F.col(time)
    return spread.select(
        *series, F.col("d").alias(time), *[F.when(own, F.col(f"`{c}`")).alias(c) for c in rest]
    )


def interpolate_short_gaps(
    df: DataFrame, series: Sequence[str], cols: Sequence[str], limit: int, time: str = "date"
) -> DataFrame:
    """Linear interpolation by row, reaching at most ``limit`` rows from a known value.

    Works in both directions: ends are held at the nearest known value, and the middle of a
    gap longer than twice the limit stays empty.
    """
    fwd = Window.partitionBy(*series).orderBy(time)
    back = Window.partitionBy(*series).orderBy(F.desc(time))
    so_far = (Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("pos", F.row_number().over(fwd))
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("pos").alias("p"), F.col(c).alias("v")))
             for c in cols}
    out = out.withColumns({
        **{f"{c}_prev": F.last(k, ignorenulls=True).over(fwd.rowsBetween(*so_far)) for c, k in known.items()},
        **{f"{c}_next": F.last(k, ignorenulls=True).over(back.rowsBetween(*so_far)) for c, k in known.items()},
    })
    filled = {}
    for c in cols:
        pp, pv = F.col(f"{c}_prev.p"), F.col(f"{c}_prev.v")
        np_, nv = F.col(f"{c}_next.p"), F.col(f"{c}_next.v")
        near = F.coalesce(F.col("pos") - pp <= limit, F.lit(False)) | F.coalesce(
            np_ - F.col("pos") <= limit, F.lit(False)
        )
        line = pv + F.try_divide((nv - pv) * (F.col("pos") - pp), np_ - pp)
        filled[c] = F.coalesce(F.col(c), F.when(near, F.coalesce(line, pv, nv)))
    helpers = ["pos", *[f"{c}_{s}" for c in cols for s in ("prev", "next")]]
    return out.withColumns(filled).drop(*helpers)


def clip_calendar_series(
    df: DataFrame, series: Sequence[str], cols: Sequence[str],
    low: float = CLIP_LOW, high: float = CLIP_HIGH,
) -> DataFrame:
    """Quantile clip of calendar-bounded series, inside the window partition they share."""
    w = Window.partitionBy(*series)
    out = df.withColumns({
        f"{c}_q": F.percentile(c, F.array(F.lit(low), F.lit(high))).over(w) for c in cols
    })
    clipped = {c: clamp(F.col(c), F.col(f"{c}_q")[0], F.col(f"{c}_q")[1]) for c in cols}
    return out.withColumns(clipped).drop(*[f"{c}_q" for c in cols])


def clip_quantiles(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str],
    low: float = CLIP_LOW, high: float = CLIP_HIGH,
) -> DataFrame:
    """Quantile clip per key (no keys: the whole table) for groups of any size."""
    want = {}
    for c in cols:
        want[f"{c}_lo"], want[f"{c}_hi"] = (c, low), (c, high)
    out = attach(df, group_stats(df, keys, cols, want), keys)
    clipped = {c: clamp(F.col(c), F.col(f"{c}_lo"), F.col(f"{c}_hi")) for c in cols}
    return out.withColumns(clipped).drop(*want)


_BLOCK = 4096


def centred_mean(
    df: DataFrame, series: Sequence[str], cols: dict[str, str], time: str = "date",
    tie: Sequence[str] = (), window: int = 7, peak: dict[str, str] | None = None,
) -> DataFrame:
    """Centred moving mean over rows; needs ``max(1, window // 2)`` known values.

    ``cols`` maps output to input column. A series of any length is numbered first (a count
    per day gives each day's starting row number) and then cut into blocks of rows that
    carry a few neighbours on both sides, so no task ever holds a whole series.
    """
    half = window // 2
    series = list(series)
    order = [time, *tie]
    day = [*series, "blk_day"]
    rows = df.withColumn("blk_day", F.to_date(F.col(time)))
    per_day = rows.groupBy(*day).agg(F.count("*").alias("blk_n"))
    w = Window.partitionBy(*series).orderBy("blk_day")
    start = per_day.withColumn(
        "blk_start", F.sum("blk_n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("blk_n")
    ).drop("blk_n")
    rows = attach(rows, start, day).withColumn(
        "blk_pos",
        F.col("blk_start") + F.row_number().over(Window.partitionBy(*day).orderBy(*order)) - 1,
    )
    own = F.floor(F.col("blk_pos") / _BLOCK)
    inside = F.col("blk_pos") % _BLOCK
    blocks = F.array_compact(F.array(
        F.when(inside < half, own - 1), own, F.when(inside >= _BLOCK - half, own + 1)
    ))
    rows = rows.withColumn("blk_own", own).withColumn("blk", F.explode(blocks))
    around = Window.partitionBy(*series, "blk").orderBy("blk_pos").rowsBetween(-half, window - 1 - half)
    means = {
        out: F.when(F.count(c).over(around) >= max(1, half), F.avg(c).over(around))
        for out, c in cols.items()
    }
    helpers = ["blk_day", "blk_start", "blk_pos", "blk_own", "blk"]
    return rows.withColumns(means).where("blk = blk_own").drop(*helpers)


def any_value_present(df: DataFrame, series: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Per series: does it hold any value at all in each column? (``has_<col>``)"""
    return df.groupBy(*series).agg(*[F.bool_or(F.col(c).isNotNull()).alias(f"has_{c}") for c in cols])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
