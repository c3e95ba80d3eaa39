"""Index observations: per (file, lake) and per file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.functions.cleaning import clean_index, to_number
from limnia.functions.timelabel import time_label
from limnia.operators.schema import OBSERVATION_COLUMNS, check_raster, complete_columns, require
from limnia.operators.spatial import lake_pixels
from limnia.operators.quantiles import group_stats
from limnia.operators.zonal import (
    SHARED, file_lake_rows, in_runs, overlap, regional_stats, row_runs, run_stats, with_blank, zonal_stats,
)
from limnia.session import materialise

# Usable columns of a file table: time0, start, end; or attrs, a map of raw attributes.
_TIME_FIELDS = ("time0", "start", "end")
# Raw attribute names, in order of preference.
_ATTRIBUTES = {"start": ("time_coverage_start", "start_time"), "end": ("time_coverage_end", "end_time")}
_BOUNDS = ("valid_min", "valid_max")


def clean_pixels(pixels: DataFrame, value: str, valid_min=None, valid_max=None) -> DataFrame:
    """Pixels with readings outside the valid range or at background level blanked out."""
    return check_raster(pixels, value).withColumn(value, clean_index(value, valid_min, valid_max))


def file_attributes(files: DataFrame) -> DataFrame:
    """Columns start, end, valid_min and valid_max from a file table's ``attrs`` map."""
    if "attrs" not in files.columns:
        return files

    def attr(name):
        return F.nullif(F.col("attrs")[name], F.lit(""))

    new = {c: F.coalesce(*map(attr, names)) for c, names in _ATTRIBUTES.items()}
    new.update({b: to_number(attr(b)) for b in _BOUNDS})
    return files.withColumns({c: v for c, v in new.items() if c not in files.columns})


def label_files(files: DataFrame, product: str) -> DataFrame:
    """Files with their ``time`` label; a file without any usable label fails the job."""
    have = {c: F.col(c) for c in _TIME_FIELDS if c in files.columns}
    out = files.withColumn(
        "time", time_label("src", product, have.get("time0"), have.get("start"), have.get("end"))
    )
    return require(out, F.col("time").isNotNull(), "no date in attributes or file name")


def _prepare(pixels, files, product, valid_min, valid_max):
    """The stored file table (src, time, engine) and the bounds to clean pixels with.

    Bounds given by the caller win; else those each file states are joined to its pixels.
    The labelled files are written out because they are used several times and, as a lazy
    plan, the optimiser would carry the label's text parsing over to the pixel side.
    """
    files = file_attributes(files)
    engine = F.col("engine") if "engine" in files.columns else F.lit("table").alias("engine")
    own = valid_min is None and valid_max is None and set(_BOUNDS) <= set(files.columns)
    labels = materialise(label_files(files, product).select("src", "time", engine, *(_BOUNDS if own else ())))
    if own:
        pixels = pixels.join(labels.select("src", *_BOUNDS), "src", "left")
        valid_min, valid_max = F.col("valid_min"), F.col("valid_max")
    return pixels, labels.drop(*_BOUNDS), valid_min, valid_max


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics with their file's label; a file that the file table doesn't list fails the job."""
    out = stats.join(labels.withColumn("listed", F.lit(True)), "src", "left")
    return require(out, F.col("listed"), "pixels of a file that the file table does not list").drop("listed")


def extract_lakes(
    pixels: DataFrame, boxes: DataFrame, files: DataFrame, product: str, value: str = "CI_cyano",
    valid_min=None, valid_max=None, keep_empty: bool = True,
) -> DataFrame:
    """One row per (file, lake box): ``lake_id, time, product, CI_mean, CI_p90, n_valid, src, engine``.

    Valid bounds given here win over those the file table states. Time labels are attached
    to the per-file result, not to the pixels.
    """
    pixels, labels, valid_min, valid_max = _prepare(pixels, files, product, valid_min, valid_max)
    clean = clean_pixels(pixels, value, valid_min, valid_max)
    stats = zonal_stats(clean, boxes, value, ["src"], labels.select("src"), keep_empty)
    return _labelled(stats, labels).select(
        "lake_id", "time", F.lit(product).alias("product"), "CI_mean", "CI_p90", "n_valid", "src", "engine"
    )


def daily_observations(pixels, boxes, files, value="CI_cyano", valid_min=None, valid_max=None) -> DataFrame:
    """Daily lake table in its stored form: ``date`` instead of ``time``, fixed column order."""
    rows = extract_lakes(pixels, boxes, files, "daily", value, valid_min, valid_max)
    return complete_columns(rows.withColumnRenamed("time", "date"), OBSERVATION_COLUMNS)


def monthly_observations(pixels, boxes, files, value="CI_cyano", valid_min=None, valid_max=None) -> DataFrame:
    """Monthly lake table; the label stays ``time``, in mid-month."""
    return extract_lakes(pixels, boxes, files, "monthly", value, valid_min, valid_max)


def extract_lakes_by_polygon(
    pixels: DataFrame, polygons: DataFrame, grid: DataFrame, files: DataFrame, product: str, value: str = "CI_cyano",
    valid_min=None, valid_max=None, inset_m: float | None = None, keep_empty: bool = True,
) -> DataFrame:
    """Like :func:`extract_lakes`, with true lake shapes (inside their inset, if they state one).

    Membership is decided once for the grid; the stored table's real size decides how pixels
    are joined to it. Where a pixel lies in more than SHARED lakes in the mean, lakes share counts
    by place (:func:`run_stats`) and don't meet each of their readings; the result is the same.
    """
    pixels, labels, valid_min, valid_max = _prepare(pixels, files, product, valid_min, valid_max)
    members = materialise(row_runs(lake_pixels(grid, polygons, inset_m)))
    clean = pixels.withColumn(value, clean_index(value, valid_min, valid_max))
    if keep_empty:
        blank = file_lake_rows(labels.select("src"), polygons.select("lake_id").distinct())
    if overlap(members) > SHARED:
        stats = run_stats(clean, members, ["src"], value)
        if keep_empty:
            stats = with_blank(stats, blank, ["src", "lake_id"])
    else:
        hits = in_runs(clean, members).select("src", "lake_id", value)
        if keep_empty:
            hits = hits.unionByName(blank.withColumn(value, F.lit(None).cast(dict(pixels.dtypes)[value])))
        stats = group_stats(hits, ["src", "lake_id"], [value], {"CI_p90": (value, 0.9)}, {"n_valid": value}, {"CI_mean": value})
    return _labelled(stats, labels).select(
        "lake_id", "time", F.lit(product).alias("product"), "CI_mean", "CI_p90", "n_valid", "src", "engine"
    )


def regional_series(
    pixels: DataFrame, files: DataFrame, product: str, value: str = "CI_cyano",
    valid_min=None, valid_max=None,
) -> DataFrame:
    """One row per readable file over the whole region, with its time label and, daily, its reader.

    A NULL ``engine`` in the file table marks a file that no reader could open; it has no row.
    """
    unread = files.where("engine IS NULL").select("src") if "engine" in files.columns else None
    files = files if unread is None else files.where("engine IS NOT NULL")
    pixels, labels, valid_min, valid_max = _prepare(pixels, files, product, valid_min, valid_max)
    clean = pixels.withColumn(value, clean_index(value, valid_min, valid_max))
    stats = regional_stats(clean, value, ["src"])
    if unread is not None:
        stats = stats.join(unread, "src", "left_anti")
    out = _labelled(stats, labels)
    if product == "monthly":
        return out.select("time", "CI_mean", "CI_p90", "n_valid")
    return out.select(F.col("time").alias("date"), "CI_mean", "CI_p90", "n_valid", "src", "engine")
