"""Column-level plumbing: renames, missing columns, name resolution, checks."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnia.functions.timelabel import to_utc_timestamp

# Accepted column names, in order of preference.
NAME_COLUMNS = ("lake_name", "Lake_name", "name", "Name")
COUNT_ALIASES = ("valid_count", "count_valid", "num_valid", "n", "count")
TIME_COLUMNS = ("date", "time")
OBSERVATION_COLUMNS = {
    "lake_id": "string", "date": "timestamp_ntz", "product": "string", "CI_mean": "double",
    "CI_p90": "double", "n_valid": "bigint", "src": "string", "engine": "string",
}


class SchemaError(ValueError):
    """An input lacks a column or value the operation cannot do without."""


def require(df: DataFrame, ok: Column, message: str) -> DataFrame:
    """Fail the job on the first row where ``ok`` is not true; adds no extra pass."""
    return df.where(F.when(F.coalesce(ok, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.lit(message)).cast("boolean")
    ))


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, names)
    if missing:
        raise SchemaError(f"missing columns: {missing}")
    return df


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    return sorted(set(expected) - set(df.columns))


def warn_missing(df: DataFrame, expected: Iterable[str], where: str = "input") -> list[str]:
    missing = missing_columns(df, expected)
    if missing:
        warnings.warn(f"{where} lacks columns {missing}", stacklevel=2)
    return missing


def complete_columns(df: DataFrame, wanted: dict[str, str] | None = None) -> DataFrame:
    """Exactly the wanted columns, in order; absent ones become typed NULLs."""
    wanted = wanted or OBSERVATION_COLUMNS
    return df.select(*[
        F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(t).alias(c)
        for c, t in wanted.items()
    ])


def provenance(df: DataFrame, **constants) -> DataFrame:
    """Constant columns such as product, source file or reader."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def drop_repeated_columns(df: DataFrame) -> DataFrame:
    """Keep the first of several columns with one name (exact, case-sensitive match)."""
    seen, keep = set(), []
    for i, name in enumerate(df.columns):
        if name not in seen:
            seen.add(name)
            keep.append((i, name))
    if len(keep) == len(df.columns):
        return df
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{i}").alias(name) for i, name in keep])


def resolve_column(df: DataFrame, candidates: Sequence[str] = NAME_COLUMNS) -> str | None:
    """First candidate the table has."""
    return next((c for c in candidates if c in df.columns), None)


def with_lake_name(df: DataFrame, id_col: str = "lake_id") -> DataFrame:
    """Give the table a ``lake_name``: the first known name column, else the id itself."""
    found = resolve_column(df)
    if found == "lake_name":
        return df
    if found:
        return df.withColumnRenamed(found, "lake_name")
    return df.withColumn("lake_name", F.col(id_col).cast("string"))


def resolve_time_column(df: DataFrame, prefer: Sequence[str] = TIME_COLUMNS) -> str:
    """``date``, then ``time``, then the first column whose name mentions either."""
    found = resolve_column(df, prefer) or next(
        (c for c in df.columns if any(w in c.lower() for w in ("date", "time"))), None
    )
    if found is None:
        raise SchemaError("no column that looks like a date or time")
    return found


def ensure_date(df: DataFrame, prefer: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """A ``date`` column (TIMESTAMP_NTZ on the UTC clock); unreadable rows are dropped."""
    source = resolve_time_column(df, prefer)
    return df.withColumn("date", to_utc_timestamp(df, source)).where("date IS NOT NULL")


def rejected_dates(df: DataFrame, prefer: Sequence[str] = TIME_COLUMNS) -> DataFrame:
    """How many rows :func:`ensure_date` drops: ``rows, rows_dropped``."""
    source = resolve_time_column(df, prefer)
    return df.select(to_utc_timestamp(df, source).alias("d")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("d").isNull()).alias("rows_dropped")
    )


def choose_count_column(df: DataFrame, target: str = "n_valid") -> DataFrame:
    """Make ``n_valid`` the first of it and its aliases that holds any positive count.

    Decided by data, in one small aggregation over the candidate columns only. When none
    has a positive value ``n_valid`` becomes NULL, so that coverage reads as unknown.
    """
    candidates = [c for c in (target, *COUNT_ALIASES) if c in df.columns]
    chosen = None
    if candidates:
        row = df.agg(*[F.bool_or(F.col(f"`{c}`") > 0).alias(f"p{i}") for i, c in enumerate(candidates)]).first()
        chosen = next((c for i, c in enumerate(candidates) if row[i]), None)
    if chosen == target:
        return df
    if chosen is None:
        return df.withColumn(target, F.lit(None).cast("bigint"))
    return df.drop(target).withColumnRenamed(chosen, target)


# Coordinate spellings and their normal form.
_COORDINATES = {"longitude": "lon", "latitude": "lat", "X": "x", "Y": "y"}


def normalise_coordinates(df: DataFrame, dims: Sequence[str] | None = None) -> DataFrame:
    """Rename coordinate columns to lon/lat or x/y.

    With neither pair present, the last two of ``dims`` (row, then column) become y and x.
    """
    cols = set(df.columns)
    if {"lon", "lat"} <= cols or {"x", "y"} <= cols:
        return df
    for pair in (("longitude", "latitude"), ("X", "Y"), ("X", "y"), ("x", "Y")):
        if set(pair) <= cols:
            return df.withColumnsRenamed({c: _COORDINATES[c] for c in pair if c in _COORDINATES})
    if dims is None or len(dims) < 2:
        raise SchemaError(f"no coordinate columns among {df.columns}")
    return df.withColumnsRenamed({dims[-2]: "y", dims[-1]: "x"})


def bind_axes(df: DataFrame, x_axis: DataFrame, y_axis: DataFrame) -> DataFrame:
    """Attach 1-D coordinates: ``x_axis(x, lon)`` and ``y_axis(y, lat)``."""
    return df.join(x_axis, "x", "left").join(y_axis, "y", "left")


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Sorted rows, missing keys last; ids sort as text."""
    return df.orderBy(*[F.asc_nulls_last(k) for k in keys])


def check_raster(df: DataFrame, value: str, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """The value and both coordinates must exist, and every pixel must have a position."""
    require_columns(df, [value, lon, lat])
    return require(df, F.col(lon).isNotNull() & F.col(lat).isNotNull(),
                   "pixel without a position: grid and values differ in shape")


def check_srid(df: DataFrame, srid: str = "srid") -> DataFrame:
    require_columns(df, [srid])
    return require(df, F.col(srid).isNotNull(), "polygon without a coordinate reference system")


def in_listed_order(df: DataFrame, name: str, order: Sequence[str], strict: bool = True) -> DataFrame:
    """Rows named in ``order``, with a 0-based ``ord``.

    ``strict`` fails when a listed name is absent; the check looks at distinct names only.
    """
    from limnia.functions.text import list_rank

    out = df.withColumn("ord", list_rank(name, order)).where("ord IS NOT NULL")
    if strict:
        have = {r[0] for r in out.select(name).distinct().limit(len(order) + 1).collect()}
        absent = [n for n in order if n not in have]
        if absent:
            raise SchemaError(f"names not found: {absent}")
    return out
