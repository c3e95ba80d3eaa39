"""Missing values and index cleaning.

Only NULL means "missing" inside the library. Spark sorts NaN above every number
and ``NaN > x`` is true, so NaN and infinities are turned into NULL at the door.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: index readings at or below this are background.
NEAR_ZERO = 5e-5


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value if it is a finite number, else NULL."""
    c = as_col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def finite_columns(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Apply :func:`finite` to the given (default: all) float and double columns."""
    floats = [n for n, t in df.dtypes if t in ("float", "double")]
    names = [c for c in floats if cols is None or c in cols]
    return df.withColumns({c: finite(c) for c in names}) if names else df


def to_number(c: Column | str) -> Column:
    """Lenient cast: text that is no number becomes NULL instead of an error."""
    return finite(as_col(c).try_cast("double"))


def _bound(b, like: Column) -> Column:
    """A bound in the precision of the values it is compared with, as DOUBLE; NULL if not finite."""
    b = F.lit(None) if b is None else b if isinstance(b, Column) else F.lit(b)
    wide = b.cast("double")
    return finite(F.when(F.typeof(like) == "float", wide.cast("float").cast("double")).otherwise(wide))


def near_zero_threshold(valid_min=None, near_zero: float = NEAR_ZERO, like: Column | None = None) -> Column:
    """The larger of the lower bound (when finite) and the background level, as DOUBLE.

    Both are rounded to the type of ``like``, the pixels they are meant for (default: FLOAT).
    """
    like = F.lit(0).cast("float") if like is None else like
    z = _bound(near_zero, like)
    return F.greatest(F.coalesce(_bound(valid_min, like), z), z)


def clean_index(
    c: Column | str, valid_min=None, valid_max=None, near_zero: float = NEAR_ZERO
) -> Column:
    """Blank out readings outside the valid range or at background level.

    Bounds are inclusive, may be numbers or columns, and are skipped when missing or not
    finite; the background test is strict. Bounds are rounded to the pixels' own type: beside
    single-precision pixels a wider bound would move readings that sit exactly on it, and a
    narrower one beside double-precision pixels.
    """
    v = finite(c)
    lo, hi = _bound(valid_min, v), _bound(valid_max, v)
    ok = (
        F.coalesce(v >= lo, lo.isNull())
        & F.coalesce(v <= hi, hi.isNull())
        & (v > near_zero_threshold(valid_min, near_zero, v))
    )
    return F.when(ok, v)
