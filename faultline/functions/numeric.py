"""Null-aware numeric column rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: numeric prefix accepted by a lenient float parse ("12abc" -> 12).
NUMERIC_PREFIX = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip_keep_null(c, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``greatest/least`` would turn NULL into a bound), NaN is missing too."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def negative_to_null(c) -> Column:
    """Below zero -> NULL; NaN (which compares above everything) is missing too."""
    c = _c(c)
    return F.when((c < 0) | F.isnan(c), F.lit(None)).otherwise(c)


def above_to_null(c, limit: float) -> Column:
    """Strictly above ``limit`` -> NULL. NaN compares above everything in Spark, so NaN -> NULL too."""
    c = _c(c)
    return F.when(c > limit, F.lit(None)).otherwise(c)


def nan_to_null(c) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def half_even(c, scale: int = 2) -> Column:
    """Banker's rounding (0.125 -> 0.12), the rounding pandas/numpy use."""
    return F.bround(_c(c), scale)


def lenient_number(c, default: float = 0.0) -> Column:
    """Parse the numeric prefix of a string; empty / non-numeric -> ``default``."""
    s = F.regexp_replace(_c(c).cast("string"), r"^\s+|\s+$", "")
    prefix = F.regexp_extract(s, NUMERIC_PREFIX, 0)
    return F.coalesce(prefix.try_cast("double"), F.lit(float(default)))
