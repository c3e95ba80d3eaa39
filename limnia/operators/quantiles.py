"""Exact group statistics, whatever the size of a group.

The built-in ``percentile`` keeps a map of every distinct value of a group in one
aggregation buffer, which is hopeless for a group holding a third of a pixel table. Groups
of every size are solved by counting instead, which never gathers a group into one task:

1. every value gets an order-preserving cell (65,536 per power of two); rows are counted per
   (group, cell) with map-side combine, so what is shuffled is a histogram;
2. running counts over the histogram tell which cell holds each wanted rank. Only these cells
   go on, a few for each group; they are written. Cells with one or two values are solved on the
   spot (the answer is the cell's min or max), and in most tables these are all;
3. where a rank's cell holds more values, the rows of such cells are read again and counted by
   distinct value; double columns are first split twice, 65,536 ways each, by position inside
   the cell. Without such a cell there is no second look at the input.

Histogram size is bounded by the number format, not by the data: a float32 cell holds at most
128 distinct values, a twice split double cell a handful, and a value repeated a billion times
is one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnia.functions.cleaning import finite
from limnia.session import materialise

_PER_OCTAVE = 65_536
_SPLITS = 65_536


def _cell(v: Column) -> Column:
    """Order-preserving integer cell of a finite double."""
    mag = (F.floor(F.log2(F.abs(v)) * _PER_OCTAVE) + F.lit(1100 * _PER_OCTAVE)).cast("int")
    return F.when(v > 0, mag).when(v < 0, -mag).when(v == 0, F.lit(0))


def _equal(cols: Sequence[str], left: str, right: str) -> Column:
    """Null-safe equality of the named columns of two aliased tables."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in cols]
    )


def _attach_goals(rows: DataFrame, goals: DataFrame, on: list[str]) -> DataFrame:
    """Keep only rows in a cell that still has open ranks, and carry those ranks along."""
    extra = [c for c in goals.columns if c not in on]
    r, o = rows.alias("r"), goals.alias("o")
    return r.join(o, _equal(on, "r", "o")).select("r.*", *[F.col(f"o.{c}") for c in extra])


def _running(df: DataFrame, part: list[str], order: str) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("upto", F.sum("n").over(w))


def _inside(k: Column) -> Column:
    """Is rank ``k`` among the ``n`` rows that end at running count ``upto``?"""
    return (k < F.col("upto")) & (k >= F.col("upto") - F.col("n"))


def _resolve_open(rows: DataFrame, goals: DataFrame, group: list[str], split: bool) -> DataFrame:
    """Target and weighted value of every open goal.

    Goals are joined twice: their keys first, to pick the rows, and their ranks after the
    rows have been counted, so that the counting carries plain columns only.
    """
    at = [*group, "cell"]
    near = _attach_goals(rows, goals.drop("goals"), at)
    ranks = goals.select(*at, "goals")
    if split:
        share = (F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * _SPLITS
        near = near.withColumn("sub", F.floor(share).cast("int"))
        near = near.withColumn("sub2", F.floor((share - F.col("sub")) * _SPLITS).cast("int"))
        counts = near.groupBy(*at, "sub", "sub2", "v").agg(F.count("*").alias("n"))
        for level in ("sub", "sub2"):
            subs = counts.groupBy(*at, level).agg(F.sum("n").alias("n"))
            subs = _attach_goals(_running(subs, at, level), ranks, at)
            rebased = F.transform(
                F.filter("goals", lambda g: _inside(g["k"])),
                lambda g: F.struct(
                    g["t"].alias("t"), g["weight"].alias("weight"),
                    (g["k"] - (F.col("upto") - F.col("n"))).alias("k"),
                ),
            )
            at = [*at, level]
            ranks = subs.withColumn("goals", rebased).where(F.size("goals") > 0).select(*at, "goals")
    else:
        counts = near.groupBy(*at, "v").agg(F.count("*").alias("n"))
    counts = _running(_attach_goals(counts, ranks, at), at, "v")
    hit = counts.withColumn("g", F.explode(F.filter("goals", lambda g: _inside(g["k"]))))
    return hit.select(*group, "g.t", (F.col("v") * F.col("g.weight")).alias("part"))


def _wanted(p: float) -> list[tuple[Column, Column]]:
    """The ranks below and above a quantile's position among ``total`` values, with their weights."""
    pos = F.lit(p) * (F.col("total") - 1)
    frac = pos - F.floor(pos)
    return [(F.floor(pos), 1 - frac), (F.ceil(pos), frac)]


def _at_rank(k: Column) -> Column:
    """The value of rank ``k`` in its cell, if it is at either end of the cell or the cell has one value."""
    own = k - (F.col("upto") - F.col("n"))
    return F.when((own == 0) | (F.col("lo") == F.col("hi")), F.col("lo")).when(own == F.col("n") - 1, F.col("hi"))


def group_stats(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    quantiles: dict[str, tuple[str, float]] | None = None,
    counts: dict[str, str] | None = None,
    means: dict[str, str] | None = None,
) -> DataFrame:
    """Per key: exact linear-interpolated quantiles, valid counts and means.

    ``quantiles`` maps an output name to ``(column, probability)``; ``counts`` and ``means``
    map an output name to a column. Missing values (NULL, NaN, infinite) are skipped, and a
    group with none left still yields its row: NULL, NULL, 0. NULL keys form a group.
    """
    quantiles, counts, means = quantiles or {}, counts or {}, means or {}
    cols = list(cols)
    idx = {c: i for i, c in enumerate(cols)}
    targets = [(idx[c], float(p)) for c, p in quantiles.values()]
    types = dict(df.dtypes)
    # working names for the keys, so that callers' names cannot clash with ours
    names = {f"g{i}": key for i, key in enumerate(keys)}
    keys = list(names)
    named = [F.col(f"`{key}`").alias(g) for g, key in names.items()]

    if len(cols) == 1:
        group = keys
        rows = df.select(*named, finite(F.col(cols[0]).cast("double")).alias("v"))
    else:
        group = [*keys, "ci"]
        cells = F.array(*[
            F.struct(F.lit(i).alias("ci"), finite(F.col(c).cast("double")).alias("v"))
            for c, i in idx.items()
        ])
        rows = df.select(*named, F.explode(cells).alias("m")).select(*keys, "m.ci", "m.v")
    rows = rows.withColumn("cell", _cell(F.col("v")))

    def of(i: int) -> Column:
        return F.col("ci") == i if len(cols) > 1 else F.lit(True)

    table = rows.groupBy(*group, "cell").agg(
        F.count("v").alias("n"), F.sum("v").alias("s"),
        F.min("v").alias("lo"), F.max("v").alias("hi"),
    )
    whole = Window.partitionBy(*group)
    table = _running(table, group, "cell").withColumns({"total": F.sum("n").over(whole), "sum": F.sum("s").over(whole)})
    # per quantile two ranks; one cell of a group stays in any case, for its total and sum
    ranks = [
        (t, k, w, of(ci) & _inside(k) & (w > 0)) for t, (ci, p) in enumerate(targets) for k, w in _wanted(p)
    ]
    here = reduce(lambda x, y: x | y, [r[3] for r in ranks], F.col("upto") == F.col("n"))
    table = materialise(table.where(here).select(*group, "cell", "n", "upto", "total", "sum", "lo", "hi"))

    goals = F.array(*[
        F.when(inside & _at_rank(k).isNull(), F.struct(
            F.lit(t).alias("t"), w.alias("weight"), (k - (F.col("upto") - F.col("n"))).alias("k")))
        for t, k, w, inside in ranks
    ]) if ranks else F.array()
    goals = table.withColumn("goals", F.filter(goals, lambda g: g.isNotNull())).where(F.size("goals") > 0)
    parts = table.select(*group, "total", "sum", *[
        F.when(inside, _at_rank(k) * w).alias(f"p{i}") for i, (_, k, w, inside) in enumerate(ranks)
    ])
    if ranks and not goals.isEmpty():
        single = all(types.get(c) in ("float", "tinyint", "smallint") for c in cols)
        fine = _resolve_open(rows, goals.select(*group, "cell", "lo", "hi", "goals"), group, split=not single)
        parts = parts.unionByName(fine.select(*group, *[
            F.when(F.col("t") == t, F.col("part")).alias(f"p{i}") for i, (t, *_) in enumerate(ranks) if i % 2 == 0
        ]), allowMissingColumns=True)

    aggs = []
    for out, c in means.items():
        s, n = (F.max(F.when(of(idx[c]), F.col(x))) for x in ("sum", "total"))
        aggs.append(F.try_divide(s, n).alias(out))
    for out, c in counts.items():
        n = F.max(F.when(of(idx[c]), F.col("total")))
        aggs.append(F.coalesce(n, F.lit(0)).cast("bigint").alias(out))
    for t, (out, (ci, _)) in enumerate(zip(quantiles, targets, strict=True)):
        low, high = (F.coalesce(F.sum(f"p{2 * t + i}"), F.lit(0.0)) for i in (0, 1))
        aggs.append(F.when(F.max(F.when(of(ci), F.col("total"))) > 0, low + high).alias(out))
    return parts.groupBy(*keys).agg(*aggs).withColumnsRenamed(names)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join per-key statistics back; with no keys the single row goes to every row.

    NULL keys match each other. No broadcast is forced: the planner broadcasts ``stats``
    only when its size allows it.
    """
    keys = list(keys)
    names = [c for c in stats.columns if c not in keys]
    # a column both sides have keeps the rows' own value where there is one
    both = [c for c in names if c in df.columns]
    l, r = df.alias("l"), stats.alias("r")
    if keys:
        own = [F.coalesce(f"l.{c}", f"r.{c}").alias(c) if c in both else F.col(f"l.{c}") for c in df.columns]
        return l.join(r, _equal(keys, "l", "r"), "left").select(*own, *[F.col(f"r.{c}") for c in names if c not in both])
    # one-row table: scalar subqueries, resolved once and folded in as literals
    one = stats.select(F.struct(*names).alias("st"))
    return df.withColumn("st", one.scalar()).select("*", *[F.col(f"st.{c}") for c in names]).drop("st")
