"""Quality control of regional and lake series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnia.functions import flags as fl
from limnia.functions.cleaning import finite_columns, to_number
from limnia.operators.quantiles import attach, group_stats
from limnia.operators.schema import choose_count_column, drop_repeated_columns, ensure_date, warn_missing
from limnia.operators.series import (
    clip_calendar_series, fill_calendar, first_per_period, interpolate_short_gaps,
)
from limnia.session import materialise

INDEX_COLUMNS = ("CI_mean", "CI_p90")
COVERAGE_FLAGS = ("qc_low_cov_geom", "qc_low_cov_emp", "qc_tiny_abs_pix")


def regional_quality(
    df: DataFrame, freq: str = "D", series: str | None = None, interp_limit: int | None = None,
    tie: tuple[str, ...] = (),
) -> DataFrame:
    """Regular calendar, short gaps interpolated, outliers clipped, low coverage flagged.

    ``series`` names the column telling several series apart; without it the table is one
    series. Raw rows are reduced to one per period before anything is ordered, so the window
    steps work on calendar-sized partitions and share a single shuffle.
    """
    warn_missing(df, [*INDEX_COLUMNS, "n_valid"], "regional series")
    key = series or "series_id"
    if series is None:
        df = df.withColumn(key, F.lit("region"))
    df = ensure_date(finite_columns(df))
    df = first_per_period(df, [key], freq, tie=tie)
    df = fill_calendar(df, [key], freq)
    cols = [c for c in INDEX_COLUMNS if c in df.columns]
    if interp_limit is None:
        interp_limit = fl.INTERP_LIMIT_DAYS if freq.upper() == "D" else fl.INTERP_LIMIT_MONTHS
    df = interpolate_short_gaps(df, [key], cols, interp_limit)
    df = clip_calendar_series(df, [key], cols)
    if "n_valid" in df.columns:
        low = F.percentile("n_valid", fl.LOW_COVERAGE_QUANTILE).over(Window.partitionBy(key))
        df = df.withColumn("low", low)
        df = df.withColumn(
            "qc_low_coverage", fl.below_flag("n_valid", F.coalesce(F.col("low"), F.lit(0.0)))
        ).drop("low")
    return df if series else df.drop(key)


def lake_quality(
    obs: DataFrame, expected: DataFrame, min_pct_geom: float = fl.MIN_PCT_VALID_GEOM,
    min_pct_emp: float = fl.MIN_PCT_VALID_EMP, min_abs_pix: int = fl.MIN_ABS_PIX,
) -> DataFrame:
    """Coverage ratios, flags, per-lake clipping and one validity verdict per row.

    ``expected`` is ``lake_id, area_m2, expected_pixels_geom, lake_name``. Everything per
    lake (best count and clip bounds) comes from one statistics pass, is written out, and is
    joined back by its real size; the rows themselves are never gathered by lake.
    """
    df = choose_count_column(finite_columns(drop_repeated_columns(obs)))
    df = ensure_date(df).drop("time")
    if "product" not in df.columns:
        df = df.withColumn("product", F.lit("unknown"))
    df = attach(df, expected, ["lake_id"])

    cols = [c for c in INDEX_COLUMNS if c in df.columns]
    want = {}
    for c in cols:
        want[f"{c}_lo"], want[f"{c}_hi"] = (c, fl.CLIP_LOW), (c, fl.CLIP_HIGH)
    best = df.groupBy("lake_id").agg(
        F.max(F.when(F.col("n_valid") > 0, F.col("n_valid"))).cast("bigint").alias("empiric_n_valid_max")
    )
    stats = attach(best, group_stats(df.select("lake_id", *cols), ["lake_id"], cols, want), ["lake_id"])
    df = attach(df, materialise(stats), ["lake_id"])

    df = df.withColumns({
        "pct_valid_geom": fl.coverage_ratio("n_valid", "expected_pixels_geom"),
        "pct_valid_emp": fl.coverage_ratio("n_valid", "empiric_n_valid_max"),
    })
    df = df.withColumns({
        "qc_low_cov_geom": fl.low_ratio_flag("pct_valid_geom", min_pct_geom),
        "qc_low_cov_emp": fl.low_ratio_flag("pct_valid_emp", min_pct_emp),
        "qc_tiny_abs_pix": fl.below_flag(to_number("n_valid"), float(min_abs_pix)),
        **{c: fl.clamp(F.col(c), F.col(f"{c}_lo"), F.col(f"{c}_hi")) for c in cols},
    })
    verdict = fl.row_is_valid([F.col(c) for c in COVERAGE_FLAGS], to_number("CI_mean"))
    return df.withColumn("qc_is_valid", verdict).drop(*want)
