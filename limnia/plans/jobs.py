"""The pipeline's steps from path to path.

Each job reads stored tables, runs one plan and writes its result. Rasters and polygons are
read as tables (see ``sources.tables``); a missing optional input skips the job, as the
return value tells.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from limnia.functions.cleaning import to_number
from limnia.operators import spatial, summary
from limnia.operators.schema import ensure_date, ordered
from limnia.plans import catalogue, climate, extraction, features, feeds, quality
from limnia.session import materialise, use_utc
from limnia.sources import files as src_files
from limnia.sources import tables


def select_lakes(spark: SparkSession, raw_polygons: str, out_candidates: str, out_lakes: str, **options) -> None:
    """Global polygon table -> candidate lakes -> the numbered study lakes."""
    cand = catalogue.candidate_lakes(tables.read_polygons(spark, raw_polygons))
    tables.write_polygons(cand, out_candidates)
    lakes = catalogue.study_lakes(spark.read.parquet(out_candidates), **options)
    tables.write_polygons(lakes, out_lakes)


def _inputs(spark, pixels, files, value, pattern):
    px = tables.read_pixels(spark, pixels, value, pattern=pattern)
    if files is not None:
        return px, tables.read_parquet(spark, files)
    return px, materialise(px.select("src").distinct())


def extract_daily(
    spark: SparkSession, pixels: str, polygons: str, out: str, files: str | None = None,
    value: str = "CI_cyano", pattern: str | None = None, audit: str | None = None, **bounds,
) -> bool:
    """Daily lake observations, sorted by lake and date. Files no reader could open are skipped.

    ``audit`` is where to put a CSV of dates, rows and lakes for each file and reader.

    ``files`` is an optional table ``src`` with any of ``time0, start, end, attrs,
    valid_min, valid_max, engine``; a NULL engine marks an unreadable file.
    """
    use_utc(spark)
    found = tables.optional(_inputs, spark, pixels, files, value, pattern)
    if found is None:
        warnings.warn(f"no daily pixels under {pixels}", stacklevel=2)
        return False
    px, listed = found
    if "engine" in listed.columns:
        px = src_files.readable_only(px, listed).drop("engine")
        listed = listed.where("engine IS NOT NULL")
    boxes = materialise(spatial.lake_boxes(tables.read_polygons(spark, polygons)))
    px = tables.near_boxes(px, boxes)
    obs = extraction.daily_observations(px, boxes, listed, value, **bounds)
    if not tables.write_parquet(ordered(obs, "lake_id", "date"), out, unless_empty=listed):
        return False
    if audit:
        tables.write_csv(summary.file_audit(spark.read.parquet(out)), audit)
    return True


def extract_monthly(
    spark: SparkSession, pixels: str, polygons: str, out: str, files: str | None = None,
    value: str = "CI_cyano", pattern: str | None = None, **bounds,
) -> bool:
    """Monthly lake observations; strict: an unreadable file fails the job."""
    use_utc(spark)
    found = tables.optional(_inputs, spark, pixels, files, value, pattern)
    if found is None:
        warnings.warn(f"no monthly pixels under {pixels}", stacklevel=2)
        return False
    px, listed = found
    if "engine" in listed.columns:
        px = src_files.readable_only(px, listed, strict=True).drop("engine")
    boxes = materialise(spatial.lake_boxes(tables.read_polygons(spark, polygons)))
    px = tables.near_boxes(px, boxes)
    return tables.write_parquet(
        extraction.monthly_observations(px, boxes, listed, value, **bounds), out, unless_empty=listed
    )


def extract_region(
    spark: SparkSession, pixels: str, out_csv: str, product: str, files: str | None = None,
    value: str = "CI_cyano", pattern: str | None = None, **bounds,
) -> bool:
    """Whole-region series as CSV, sorted by time. Files no reader could open are skipped."""
    use_utc(spark)
    px, listed = _inputs(spark, pixels, files, value, pattern)
    if "engine" in listed.columns:
        px = src_files.readable_only(px, listed).drop("engine")
    rows = extraction.regional_series(px, listed, product, value, **bounds)
    return tables.write_csv(ordered(rows, "time" if product == "monthly" else "date"), out_csv)


def check_region(spark: SparkSession, csv: str, freq: str, out_dir: str, prefix: str) -> bool:
    """``<prefix>_clean`` and ``<prefix>_summary`` of one regional series; False if there is none."""
    use_utc(spark)
    schema = tables.REGIONAL_DAILY if freq.upper() == "D" else tables.REGIONAL_SERIES
    df = tables.optional(tables.read_csv, spark, csv, schema)
    if df is None:
        return False
    clean = materialise(quality.regional_quality(df, freq, tie=tuple(c for c in ("src",) if c in df.columns)))
    tables.write_csv(ordered(clean, "date"), f"{out_dir}/{prefix}_clean")
    tables.write_csv(summary.missing_summary(clean, prefix), f"{out_dir}/{prefix}_summary")
    return True


def check_lakes(
    spark: SparkSession, observations: str, polygons: str, out_dir: str, prefix: str,
    pix_res_m: float = 300.0, inset_m: float | None = None, **limits,
) -> bool:
    """``<prefix>_clean`` (parquet), ``<prefix>_summary`` and ``<prefix>_counts`` (CSV); False without observations.

    Expected pixels are those inside the lake table's own inset unless one is given.
    """
    use_utc(spark)
    obs = tables.optional(tables.read_parquet, spark, observations)
    if obs is None:
        return False
    expected = materialise(spatial.expected_pixel_table(tables.read_polygons(spark, polygons), inset_m, pix_res_m))
    out = f"{out_dir}/{prefix}_clean"
    tables.write_parquet(quality.lake_quality(obs, expected, **limits), out)
    clean = spark.read.parquet(out)
    tables.write_csv(summary.quality_summary(clean), f"{out_dir}/{prefix}_summary")
    tables.write_csv(summary.lake_counts(clean), f"{out_dir}/{prefix}_counts")
    return True


def lake_climate(
    spark: SparkSession, cube: str, grid: str, polygons: str, out: str,
    variables: Sequence[str] = climate.VARIABLES, inset_m: float | None = None, profile: str | None = None,
) -> None:
    """Wide lake climate table, sorted by lake and date; pixels inside each lake's inset.

    ``profile`` is where to put a CSV with a line for each column.
    """
    use_utc(spark)
    rows = climate.lake_climate(
        spark.read.parquet(cube), spark.read.parquet(grid), tables.read_polygons(spark, polygons), variables, inset_m
    )
    tables.write_parquet(ordered(rows, "lake_id", "date"), out)
    if profile:
        tables.write_csv(summary.profile(spark.read.parquet(out)), profile)


def resample_climate(
    spark: SparkSession, daily: str, out_dir: str, variables: Sequence[str] = climate.VARIABLES
) -> list[str]:
    """The four resampled tables, one folder each; returns their paths."""
    use_utc(spark)
    rows = ensure_date(spark.read.parquet(daily)).withColumn("date", F.col("date").cast("timestamp_ntz"))
    paths = []
    for name, table in climate.resampled_climate(rows, variables).items():
        paths.append(f"{out_dir}/{name}")
        tables.write_parquet(ordered(table, "lake_id", "date"), paths[-1])
    return paths


def merge_features(
    spark: SparkSession, observations: str, climate_table: str, out: str, monthly: bool = False,
    variables: Sequence[str] = climate.VARIABLES, align: str | None = None,
) -> None:
    """Valid observations with climate; ``align`` defaults to the product's own period."""
    use_utc(spark)
    obs, clim = spark.read.parquet(observations), spark.read.parquet(climate_table)
    merge = features.monthly_features if monthly else features.daily_features
    rows = merge(obs, clim, variables, align or ("month" if monthly else "day"))
    tables.write_parquet(rows, out)


def chart_feeds(spark: SparkSession, checked: str, out_dir: str, monthly: bool = False, names: Sequence[str] = catalogue.NAMES) -> list[str]:
    """The tables behind the charts of a checked lake table, one folder each; returns their paths."""
    use_utc(spark)
    rows = spark.read.parquet(checked)
    made = {"lake_monthly": feeds.lake_monthly_feed(rows)} if monthly else {
        "lake_daily": feeds.lake_daily_feed(rows), "facets": feeds.facet_feed(rows, names),
        "validity": feeds.validity_matrix_feed(rows),
    }
    for name, table in made.items():
        tables.write_parquet(table, f"{out_dir}/{name}")
    return [f"{out_dir}/{name}" for name in made]


def regional_feeds(spark: SparkSession, checked: str, out: str, monthly: bool = False, series: str = "series") -> None:
    """The table behind the chart of one checked regional series (CSV, as ``check_region`` writes it)."""
    use_utc(spark)
    text = spark.read.option("header", True).csv(checked)
    rows = text.withColumns({c: to_number(c) for c in ("CI_mean", "CI_p90", "n_valid") if c in text.columns})
    rows = rows.withColumn(series, F.lit("region"))
    feed = feeds.regional_monthly_feed if monthly else feeds.regional_daily_feed
    tables.write_parquet(feed(rows, series), out)
