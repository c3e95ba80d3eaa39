"""Lake climate tables and their resampled forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnia.functions.cleaning import finite_columns
from limnia.operators.resample import monthly, trailing_mean, weekly_from_first_day, weekly_to_monday
from limnia.operators.schema import ensure_date, with_lake_name
from limnia.operators.spatial import lake_pixels
from limnia.operators.zonal import member_means, row_runs
from limnia.session import materialise

# Climate variables, in column order.
VARIABLES = ("tmin", "tmax", "prcp", "srad", "vp", "dayl")


def lake_climate(
    cube: DataFrame, grid: DataFrame, polygons: DataFrame, variables: Sequence[str] = VARIABLES,
    inset_m: float | None = None,
) -> DataFrame:
    """``lake_id, lake_name, date`` plus one spatial mean per variable.

    ``cube`` is long (time or date, y, x, var, value). Membership comes from the grid, once,
    and is stored as runs of pixels in a row; the planner broadcasts them if their size allows it,
    so that the cube is not shuffled. All variables share one scan and one aggregation, which yields the same rows as
    outer merging one table per variable.
    """
    named = with_lake_name(polygons)
    names = named.groupBy("lake_id").agg(F.min_by("lake_name", "part").alias("lake_name"))
    members = materialise(row_runs(lake_pixels(grid, named, inset_m)).join(names, "lake_id"))
    days = ensure_date(finite_columns(cube))
    return member_means(days, members, ["date"], variables)


def resampled_climate(daily: DataFrame, variables: Sequence[str] = VARIABLES) -> dict[str, DataFrame]:
    """The four derived tables, each ``lake_id, date`` and the variables."""
    return {
        "weekly_7D": weekly_from_first_day(daily, variables),
        "weekly_W-MON": weekly_to_monday(daily, variables),
        "roll28": trailing_mean(daily, variables),
        "monthly": monthly(daily, variables),
    }
