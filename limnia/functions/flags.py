"""Coverage ratios, quality flags and the constants behind them.

Two kinds of flag: *nullable* ones stay NULL when the ratio is unknown, *hard* ones read a
missing value as "not flagged".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from limnia.functions.cleaning import as_col, finite

# Defaults of the quality rules.
PIX_RES_M = 300.0
MIN_PCT_VALID_GEOM = 0.10
MIN_PCT_VALID_EMP = 0.10
MIN_ABS_PIX = 50
CLIP_LOW = 0.001
CLIP_HIGH = 0.999
INTERP_LIMIT_DAYS = 3
INTERP_LIMIT_MONTHS = 1
LOW_COVERAGE_QUANTILE = 0.05


def expected_pixels(area_m2: Column | str, pix_res_m: float = PIX_RES_M) -> Column:
    """Pixels that fit the area, rounded half to even."""
    return F.bround(as_col(area_m2) / F.lit(pix_res_m * pix_res_m)).cast("bigint")


def coverage_ratio(n_valid: Column | str, reference: Column | str) -> Column:
    n = as_col(n_valid).cast("double")
    return finite(F.try_divide(n, as_col(reference).cast("double")))


def low_ratio_flag(ratio: Column | str, minimum: float) -> Column:
    """Nullable flag: 1 below the minimum, NULL when the ratio is unknown."""
    return (as_col(ratio) < F.lit(minimum)).cast("int")


def below_flag(value: Column | str, threshold: Column | float) -> Column:
    """Hard flag: 1 below the threshold, 0 otherwise and when missing."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.coalesce(as_col(value) < t, F.lit(False)).cast("int")


def row_is_valid(flags: list[Column], value: Column) -> Column:
    """1 unless some flag is 1; with every flag unknown, 1 iff the value is finite."""
    unknown = flags[0].isNull()
    raised = F.coalesce(flags[0] == 1, F.lit(False))
    for f in flags[1:]:
        unknown = unknown & f.isNull()
        raised = raised | F.coalesce(f == 1, F.lit(False))
    return F.when(unknown, finite(value).isNotNull().cast("int")).otherwise((~raised).cast("int"))


def clamp(v: Column, lo: Column, hi: Column) -> Column:
    """Limit to [lo, hi]; missing values and missing limits leave the value as it is."""
    return F.when(v.isNotNull(), F.greatest(F.least(v, hi), lo))


def shade_height(ratio: Column, peak: Column, share: float = 0.2) -> Column:
    """Coverage in [0, 1] scaled to a share of the curve's peak; 0 where unknown."""
    r = clamp(ratio, F.lit(0.0), F.lit(1.0))
    return F.coalesce(r * peak * F.lit(share), F.lit(0.0))
