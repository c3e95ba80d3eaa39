"""Names of the files a period should have, and names taken from URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limnia.functions.cleaning import as_col
from limnia.functions.text import url_basename

# Name suffixes per region; anything but CONUS is the Alaska grid.
TAIL_CONUS = "ILW_CONUS.V5.all.CONUS.300m.nc"
TAIL_ALASKA = "ILW_ALASKA.V5.all.ILW_AK.300m.nc"
DAILY_SATELLITE = "S3M"
MONTHLY_SATELLITE = "S3A"


def region_tail(region: Column | str) -> Column:
    return F.when(as_col(region) == "CONUS", TAIL_CONUS).otherwise(TAIL_ALASKA)


def year_range(spec: str) -> tuple[int, int]:
    """"2024" or "2020-2024"."""
    first, _, last = spec.partition("-")
    return int(first), int(last or first)


def daily_name(date: Column | str, region: Column | str, satellite: str = DAILY_SATELLITE) -> Column:
    stamp = F.date_format(as_col(date), "yyyyMMdd")
    return F.concat(F.lit(f"{satellite}_OLCI_EFRNT."), stamp, F.lit(".L3m.DAY."), region_tail(region))


def monthly_name(month: Column | str, region: Column | str, satellite: Column | str = MONTHLY_SATELLITE) -> Column:
    m = as_col(month)
    sat = satellite if isinstance(satellite, Column) else F.lit(satellite)
    return F.concat(
        sat, F.lit("_OLCI_EFRNT."), F.date_format(F.trunc(m, "MM"), "yyyyMMdd"), F.lit("_"),
        F.date_format(F.last_day(m), "yyyyMMdd"), F.lit(".L3m.MO."), region_tail(region),
    )


def expected_daily(spans: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per day and region of ``spans(region, start, end)``; the end day is excluded."""
    days = F.sequence(F.col(start), F.date_sub(F.col(end), 1), F.expr("INTERVAL 1 DAY"))
    out = spans.where(F.col(start) < F.col(end)).select("region", F.explode(days).alias("date"))
    return out.withColumn("src", daily_name("date", "region"))


def expected_monthly(spans: DataFrame, satellite: str = MONTHLY_SATELLITE) -> DataFrame:
    """One row per month of ``spans(region, year1, year2, month1, month2)``, months per year."""
    years = spans.select("*", F.explode(F.sequence("year1", "year2")).alias("year"))
    months = years.where("month1 <= month2").select(
        "region", "year", F.explode(F.sequence("month1", "month2")).alias("month")
    )
    first = F.make_date("year", "month", F.lit(1))
    return months.withColumn("date", first).withColumn("src", monthly_name("date", "region", satellite)).select(
        "region", "date", "src"
    )


def daily_span(spark: SparkSession, year: int, region: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """A one-row span for :func:`expected_daily`: the whole year unless dates are given."""
    row = [(region, start or f"{year}-01-01", end or f"{year + 1}-01-01")]
    return spark.createDataFrame(row, "region string, start string, end string").select(
        "region", F.to_date("start").alias("start"), F.to_date("end").alias("end")
    )


# Climate file names: product_vN[_daily]_<region>_<variable>_<year>.<format> (daily) and
# product_vN_<variable>_<summary>_<region>_<year>.<format> (monthly).
_DAILY = r"^[a-z]+_v\d+_daily_([a-z]+)_([a-z]+)_(\d{4})\.([a-z0-9]+)$"
_MONTHLY = r"^[a-z]+_v\d+_([a-z]+)_(mon[a-z]+)_([a-z]+)_(\d{4})\.([a-z0-9]+)$"


def url_manifest(urls: DataFrame, url: str = "url") -> DataFrame:
    """File name of each URL, split into its fields (NULL where the name has another shape)."""
    out = urls.withColumn("file", url_basename(url))

    def part(rx, i):
        return F.nullif(F.regexp_extract("file", rx, i), F.lit(""))

    return out.select(
        "*",
        F.coalesce(part(_DAILY, 2), part(_MONTHLY, 1)).alias("variable"),
        F.coalesce(part(_DAILY, 1), part(_MONTHLY, 3)).alias("region"),
        part(_MONTHLY, 2).alias("summary"),
        F.coalesce(part(_DAILY, 3), part(_MONTHLY, 4)).cast("int").alias("year"),
        F.coalesce(part(_DAILY, 4), part(_MONTHLY, 5)).alias("format"),
    )
