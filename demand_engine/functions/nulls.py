"""Missing values and division.

Rule of the engine: missing is NULL. NaN is turned into NULL where data
enters, because Spark sorts NaN above every number and lets it through
``>=`` comparisons, ``avg`` and ``max``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """NaN becomes NULL; everything else is kept."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, NULL when b is zero or either side is NULL (no ANSI error)."""
    return F.try_divide(col_(a), col_(b))


def fill_zero(c: str | Column) -> Column:
    """Missing becomes 0.0."""
    return F.coalesce(nan_to_null(col_(c).cast("double")), F.lit(0.0))


def clip_negative(c: str | Column) -> Column:
    """max(x, 0) that keeps NULL as NULL (``greatest`` would turn it into 0)."""
    x = col_(c)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def clip_lower(c: str | Column, lower: float) -> Column:
    x = col_(c)
    return F.when(x < lower, F.lit(float(lower))).otherwise(x)
