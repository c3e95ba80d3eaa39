"""Audit, profile and pivot tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.functions.cleaning import finite, to_number
from limnia.functions.text import display_label
from limnia.functions.timelabel import date_text
from limnia.operators.merge import first_name_per_id
from limnia.operators.quantiles import attach, group_stats


def missing_summary(df: DataFrame, tag: str, cols: Sequence[str] = ("CI_mean", "CI_p90", "n_valid")) -> DataFrame:
    """Row count and missing values per column; NULL for a column the table lacks."""
    return df.agg(
        F.lit(tag).alias("tag"), F.count("*").alias("rows"),
        *[
            (F.count_if(F.col(c).isNull()) if c in df.columns else F.lit(None).cast("bigint")).alias(f"n_missing_{c}")
            for c in cols
        ],
    )


def lake_counts(df: DataFrame) -> DataFrame:
    """Per lake: rows, rows with a finite mean, rows with pixels, valid rows."""
    return df.where("lake_id IS NOT NULL").groupBy("lake_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if(to_number("CI_mean").isNotNull()).alias("n_CI_finite"),
        F.count_if(to_number("n_valid") > 0).alias("n_valid_pos"),
        F.coalesce(F.sum("qc_is_valid"), F.lit(0)).cast("bigint").alias("qc_valid"),
    )


def quality_summary(df: DataFrame) -> DataFrame:
    """Per lake: rows, valid rows and share, median coverages, first name; sorted by id."""
    named = df.where("lake_id IS NOT NULL")
    ratios = ["pct_valid_geom", "pct_valid_emp"]
    medians = group_stats(named, ["lake_id"], ratios, {f"{c}_med": (c, 0.5) for c in ratios})
    counts = named.groupBy("lake_id").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("qc_is_valid") == 1).alias("rows_valid"),
        F.bround(F.count_if(F.col("qc_is_valid") == 1) / F.count("*"), 4).alias("frac_valid"),
        F.min_by("lake_name", F.struct("date", "lake_name")).alias("lake_name"),
    )
    out = attach(counts, medians, ["lake_id"])
    return out.select(
        "lake_id", "rows", "rows_valid", "frac_valid", *[f"{c}_med" for c in ratios], "lake_name"
    ).orderBy(F.asc_nulls_last("lake_id"))


def file_audit(df: DataFrame, time: str | None = None) -> DataFrame:
    """Per source file and reader: dates covered, rows, lakes, and a readable date range."""
    time = time or ("date" if "date" in df.columns else "time")
    g = df.groupBy("src", "engine").agg(
        F.count_distinct(time).alias("n_dates"), F.min(time).alias("first"), F.max(time).alias("last"),
        F.count("*").alias("rows"), F.count_distinct("lake_id").alias("n_lakes"),
    )
    span = F.concat(date_text("first"), F.lit("→"), date_text("last"), F.lit(" (n="), F.col("n_dates"), F.lit(")"))
    text = F.when(F.col("n_dates") == 0, "NA").when(F.col("n_dates") == 1, date_text("first")).otherwise(span)
    return g.withColumn("date_text", text)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: counts, most frequent value, moments, exact quartiles.

    Numbers get mean, sample deviation, min, quartiles and max; text gets distinct count and
    most frequent value (ties: the smallest); dates are profiled as days since 1970.
    """
    numeric, text, cells = [], [], []
    for name, t in df.dtypes:
        c = F.col(f"`{name}`")
        if t in ("date", "timestamp", "timestamp_ntz"):
            # seconds to days keeps fractions of a day
            numeric.append((name, F.unix_micros(c.cast("timestamp")) / F.lit(86_400_000_000.0)))
        elif t == "string" or t == "boolean":
            text.append((name, c.cast("string")))
        else:
            numeric.append((name, finite(c.cast("double"))))
    for name, c in numeric:
        cells.append(F.struct(F.lit(name).alias("column"), c.alias("v"), F.lit(None).cast("string").alias("s")))
    for name, c in text:
        cells.append(F.struct(F.lit(name).alias("column"), F.lit(None).cast("double").alias("v"), c.alias("s")))
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")

    moments = long.groupBy("column").agg(
        (F.count("v") + F.count("s")).alias("count"), F.stddev("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    )
    quartiles = group_stats(
        long.where("v IS NOT NULL"), ["column"], ["v"],
        {"p25": ("v", 0.25), "p50": ("v", 0.5), "p75": ("v", 0.75)}, None, {"mean": "v"},
    )
    freq = long.where("s IS NOT NULL").groupBy("column", "s").agg(F.count("*").alias("n"))
    tops = freq.groupBy("column").agg(F.count("*").alias("unique"), F.max("n").alias("freq"))
    # ties: smallest value among the most frequent, without a second shuffle of the counts
    tops = attach(freq, tops.select("column", "unique", "freq"), ["column"]).where("n = freq").groupBy(
        "column"
    ).agg(F.first("unique").alias("unique"), F.min("s").alias("top"), F.first("freq").alias("freq"))
    out = attach(attach(moments, quartiles, ["column"]), tops, ["column"])
    return out.select(
        "column", "count", "unique", "top", "freq", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def pivot_dates(df: DataFrame, dates: Sequence[str] | None = None, key: str = "lake_id", time: str = "date",
                value: str = "qc_is_valid") -> DataFrame:
    """Key x date matrix of the largest value, rows sorted; one column per listed day, or per day of the data.

    Days become columns, so the second form first asks which days there are: a calendar's worth.
    Cells are combined first, one row per key and day, and then placed by their day's number, so
    a row costs the same whatever the number of days.
    """
    cells = df.select(key, F.to_date(time).cast("string").alias("day"), F.col(value))
    if dates is None:
        found = cells.select("day").where("day IS NOT NULL").distinct().orderBy("day").collect()
        dates = [r["day"] for r in found]
    days = [str(d) for d in dates]
    rows = cells.groupBy(key).pivot("day", days).agg(F.max(value)) if days else cells.select(key).distinct()
    return rows.orderBy(F.asc_nulls_last(key))


def validity_long(df: DataFrame, name: str | None = "lake_name") -> DataFrame:
    """Label, day and largest validity: the matrix in long form."""
    cells = df.groupBy("lake_id", F.to_date("date").alias("date")).agg(F.max("qc_is_valid").alias("qc_is_valid"))
    if name is None or name not in df.columns:
        return cells.withColumn("label", F.col("lake_id").cast("string"))
    names = first_name_per_id(df, "lake_id", name, "date").withColumnRenamed(name, "label_name")
    return attach(cells, names, ["lake_id"]).select(
        "lake_id", display_label("lake_id", "label_name").alias("label"), "date", "qc_is_valid"
    )
