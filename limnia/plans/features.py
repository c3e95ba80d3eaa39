"""Valid observations joined to climate: the table models are fed with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.operators.merge import left_by_time
from limnia.plans.climate import VARIABLES


def valid_rows(df: DataFrame, flag: str = "qc_is_valid") -> DataFrame:
    """Rows judged valid; a table that carries no verdict passes whole."""
    return df.where(F.col(flag) == 1) if flag in df.columns else df


def valid_counts(df: DataFrame, flag: str = "qc_is_valid") -> DataFrame:
    """``rows_before, rows_after`` of :func:`valid_rows`."""
    after = F.count_if(F.col(flag) == 1) if flag in df.columns else F.count("*")
    return df.agg(F.count("*").alias("rows_before"), after.alias("rows_after"))


def daily_features(
    obs: DataFrame, climate: DataFrame, variables: Sequence[str] = VARIABLES, align: str = "day"
) -> DataFrame:
    """Valid daily observations with the climate of the same lake and day.

    ``align="exact"`` matches equal time stamps only: observations labelled at, say, the
    first pixel's minute then miss climate days stamped at midnight or noon.
    """
    return left_by_time(valid_rows(obs), climate, variables, align)


def monthly_features(
    obs: DataFrame, climate_monthly: DataFrame, variables: Sequence[str] = VARIABLES, align: str = "month"
) -> DataFrame:
    """Valid monthly observations (labelled mid-month) with their month's climate."""
    return left_by_time(valid_rows(obs), climate_monthly, variables, align)
