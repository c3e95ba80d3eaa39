"""Tables behind the charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnia.functions.flags import shade_height
from limnia.functions.text import is_any, list_rank
from limnia.operators.quantiles import attach
from limnia.operators.schema import ensure_date, resolve_column
from limnia.operators.series import centred_mean
from limnia.operators.summary import pivot_dates, validity_long
from limnia.plans.catalogue import NAMES
from limnia.plans.features import valid_rows
from limnia.session import materialise

_MEANS = {"CI_mean_7": "CI_mean", "CI_p90_7": "CI_p90"}


def _means(df: DataFrame) -> dict[str, str]:
    return {out: c for out, c in _MEANS.items() if c in df.columns}


def regional_daily_feed(df: DataFrame, series: str) -> DataFrame:
    """Daily mean with 7-row centred means of both index columns."""
    d = ensure_date(df)
    return centred_mean(d, [series], _means(d)).select(series, "date", "CI_mean", *_means(d)).orderBy(series, "date")


def regional_monthly_feed(df: DataFrame, series: str) -> DataFrame:
    d = ensure_date(df)
    return d.select(series, "date", *[c for c in ("CI_mean", "CI_p90") if c in d.columns]).orderBy(series, "date")


def _per_lake(df: DataFrame, *aggs: Column) -> DataFrame:
    """One row per lake: ``title``, the name on its earliest row (the id where there is no name column), and ``aggs``."""
    name = resolve_column(df)
    title = F.min_by(name, F.struct("date", name)) if name else F.first(F.col("lake_id").cast("string"))
    return df.groupBy("lake_id").agg(title.alias("title"), *aggs)


def _has(*cols: str) -> list[Column]:
    return [F.bool_or(F.col(c).isNotNull()).alias(f"has_{c}") for c in cols]


def lake_daily_feed(df: DataFrame, tie: Sequence[str] = ("src",)) -> DataFrame:
    """Per lake and day: raw and smoothed index, coverage, and whether there is any value."""
    d = ensure_date(df)
    per_lake = _per_lake(d, *_has("CI_mean", "CI_p90", "pct_valid_geom"))
    smooth = centred_mean(d, ["lake_id"], _means(d), tie=[t for t in tie if t in d.columns])
    return attach(smooth, per_lake, ["lake_id"]).select(
        "lake_id", "title", "date", "CI_mean", *_means(d), "pct_valid_geom",
        "has_CI_mean", "has_CI_p90", "has_pct_valid_geom",
    ).orderBy("lake_id", "date")


def lake_monthly_feed(df: DataFrame) -> DataFrame:
    """Valid monthly rows per lake with what there is to draw."""
    d = valid_rows(ensure_date(df)).where("lake_id IS NOT NULL")
    return attach(d, _per_lake(d, *_has("CI_mean", "CI_p90")), ["lake_id"]).select(
        "lake_id", F.coalesce("title", "lake_id").alias("title"), "date", "CI_mean", "CI_p90",
        "has_CI_mean", "has_CI_p90",
    ).orderBy("lake_id", "date")


def _panel_rank(df: DataFrame, names: Sequence[str]) -> Column:
    """Place of a row's lake name in the list; NULL where it is not listed."""
    name = resolve_column(df)
    if name is None:
        return F.lit(None).cast("int")
    return F.when(is_any(name, names), list_rank(F.lower(F.col(name)), [n.lower() for n in names]))


def _panels(per_lake: DataFrame, limit: int | None) -> DataFrame:
    """Of the lakes with their ``ord``: the listed ones, or all if none is listed."""
    some = per_lake.agg((F.count("ord") > 0).alias("some"))
    kept = per_lake.withColumn("some", some.scalar()).where("ord IS NOT NULL OR NOT some").drop("some")
    return kept if limit is None else kept.orderBy("ord", "lake_id").limit(limit)


def facet_lakes(df: DataFrame, names: Sequence[str] = NAMES, limit: int | None = None) -> DataFrame:
    """``lake_id, ord`` of the panels: every lake of a listed name, else all lakes in text order.

    ``limit`` is for layouts with room for so many panels only.
    """
    return _panels(df.groupBy("lake_id").agg(F.min(_panel_rank(df, names)).alias("ord")), limit)


def facet_feed(
    df: DataFrame, names: Sequence[str] = NAMES, tie: Sequence[str] = ("src",), limit: int | None = None
) -> DataFrame:
    """Small-multiple panels: smoothed index and coverage shading scaled to each lake's peak."""
    d = ensure_date(df)
    # all that is known of a lake as a whole is one small table, made in one pass
    lakes = materialise(_per_lake(d, F.min(_panel_rank(d, names)).alias("ord"), F.max("CI_mean").alias("peak")))
    smooth = centred_mean(d, ["lake_id"], _means(d), tie=[t for t in tie if t in d.columns])
    return smooth.join(_panels(lakes, limit), "lake_id").select(
        "ord", "lake_id", "title", "date",
        shade_height(F.col("pct_valid_geom"), F.col("peak")).alias("coverage_height"), *_means(d),
    ).orderBy("ord", "lake_id", "date")


def validity_matrix_feed(df: DataFrame, name: str | None = "lake_name") -> DataFrame:
    """One row per lake, labelled ``id - name``, and one column per day of the data: the validity verdict."""
    return pivot_dates(materialise(validity_long(ensure_date(df), name)), key="label")
