"""Calendar resampling and trailing means of lake climate tables.

All bins are ordinary grouped averages (combined before the shuffle). Empty bins inside a
lake's span are kept as NULL rows; they are generated from the reduced table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnia.operators.quantiles import attach
from limnia.operators.series import fill_calendar

_DAY_MICROS = 86_400_000_000


def _bin_mean(df, key, label, cols, time, freq):
    binned = df.withColumn("bin", label).where("bin IS NOT NULL").groupBy(key, "bin").agg(
        *[F.avg(c).alias(c) for c in cols]
    )
    return fill_calendar(binned.withColumnRenamed("bin", time), [key], freq, time)


def weekly_from_first_day(
    df: DataFrame, cols: Sequence[str], key: str = "lake_id", time: str = "date"
) -> DataFrame:
    """Mean per 7-day bin; bins are counted from each lake's own first day."""
    first = df.groupBy(key).agg(F.to_date(F.min(time)).alias("first_day"))
    days = attach(df.select(key, time, *cols), first, [key])
    label = F.expr(f"date_add(first_day, CAST(floor(datediff({time}, first_day) / 7) AS INT) * 7)")
    return _bin_mean(days, key, label, cols, time, "W")


def weekly_to_monday(
    df: DataFrame, cols: Sequence[str], key: str = "lake_id", time: str = "date"
) -> DataFrame:
    """Mean per week running Tuesday to Monday, labelled by that closing Monday."""
    label = F.next_day(F.date_sub(F.to_date(time), 1), "MON")
    return _bin_mean(df.select(key, time, *cols), key, label, cols, time, "W")


def monthly(
    df: DataFrame, cols: Sequence[str], key: str = "lake_id", time: str = "date"
) -> DataFrame:
    """Mean per calendar month, labelled by its first day."""
    label = F.trunc(F.col(time), "MM")
    return _bin_mean(df.select(key, time, *cols), key, label, cols, time, "MS")


def trailing_mean(
    df: DataFrame, cols: Sequence[str], days: int = 28, key: str = "lake_id", time: str = "date"
) -> DataFrame:
    """Mean over the last ``days`` days up to each row; exactly ``days`` old is out.

    Expects one row per lake and time stamp. Lakes are cut into stretches of time, each
    carrying the rows of the preceding window, so a long series is spread over many tasks.
    """
    span = days * _DAY_MICROS
    stretch = 64 * span
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.select(key, time, *cols).withColumn("at", at)
    own = F.floor(F.col("at") / stretch)
    copies = F.array_compact(F.array(own, F.when(F.pmod("at", F.lit(stretch)) >= stretch - span, own + 1)))
    rows = rows.withColumn("own", own).withColumn("stretch", F.explode(copies))
    w = Window.partitionBy(key, "stretch").orderBy("at").rangeBetween(-(span - 1), 0)
    means = rows.withColumns({c: F.avg(c).over(w) for c in cols})
    return means.where("stretch = own").select(key, time, *cols)
