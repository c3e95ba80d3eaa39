"""Joins between observation, climate and attribute tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.functions.timelabel import period_start
from limnia.operators.quantiles import attach
from limnia.operators.series import first_per_key


def left_attributes(df: DataFrame, attributes: DataFrame, key: str = "lake_id") -> DataFrame:
    """Left join a per-key attribute table."""
    return attach(df, attributes, [key])


def outer_merge(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several tables, one after the other; NULL keys match."""

    def merge(left: DataFrame, right: DataFrame) -> DataFrame:
        l, r = left.alias("l"), right.alias("r")
        cond = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
        return l.join(r, cond, "full").select(
            *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
            *[F.col(f"l.{c}") for c in left.columns if c not in keys],
            *[F.col(f"r.{c}") for c in right.columns if c not in keys],
        )

    return reduce(merge, tables)


def outer_pivot(
    df: DataFrame, keys: Sequence[str], names: Sequence[str], name: str = "var", value: str = "value"
) -> DataFrame:
    """The same wide table from long rows, in one aggregation instead of a chain of joins.

    Cells hold the mean of their rows, so per-pixel rows may be passed in directly.
    """
    return df.groupBy(*keys).agg(*[
        F.avg(F.when(F.col(name) == n, F.col(value))).alias(n) for n in names
    ])


def left_by_time(
    left: DataFrame, right: DataFrame, cols: Sequence[str], align: str = "day",
    key: str = "lake_id", time: str = "date",
) -> DataFrame:
    """Left join ``right``'s columns on key and time.

    ``align`` is "exact" (equal time stamps), "day" or "month" (equal periods). The right
    side has one row per key and period in this library's climate tables.
    """
    freq = {"day": "D", "month": "MS"}.get(align)
    if freq is None and align != "exact":
        raise ValueError(f"unknown alignment {align!r}")

    def tick(c):
        return period_start(c, freq) if freq else c.cast("timestamp_ntz")

    r = right.select(F.col(key).alias("jk"), tick(F.col(time)).alias("jt"), *cols)
    l = left.withColumn("lt", tick(F.col(time)))
    on = l[key].eqNullSafe(r["jk"]) & l["lt"].eqNullSafe(r["jt"])
    return l.join(r, on, "left").drop("jk", "jt", "lt")


def union_first_wins(branches: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of tables with one row per key: the earliest branch that has it."""
    tagged = [b.withColumn("branch", F.lit(i)) for i, b in enumerate(branches)]
    both = reduce(lambda a, b: a.unionByName(b), tagged)
    return first_per_key(both, [key], ["branch"]).drop("branch")


def first_name_per_id(df: DataFrame, key: str, name: str, order: str) -> DataFrame:
    """Id -> name, the earliest non-missing name of each id."""
    named = df.where(F.col(name).isNotNull())
    return named.groupBy(key).agg(F.min_by(name, F.struct(F.col(order).isNull(), order, name)).alias(name))
