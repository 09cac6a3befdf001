"""Calendar column expressions for a ``date`` column."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_


def year(d: str | Column) -> Column:
    return F.year(col_(d))


def month(d: str | Column) -> Column:
    return F.month(col_(d))


def iso_week(d: str | Column) -> Column:
    """ISO-8601 week number, 1..53."""
    return F.weekofyear(col_(d))


def quarter(d: str | Column) -> Column:
    return F.quarter(col_(d))


def is_month_end(d: str | Column) -> Column:
    """1 on the last day of the month, else 0."""
    x = col_(d)
    return (x == F.last_day(x)).cast("int")


def cyclic_sin(x: str | Column, period: float) -> Column:
    return F.sin(F.lit(2 * math.pi) * col_(x) / F.lit(float(period)))


def cyclic_cos(x: str | Column, period: float) -> Column:
    return F.cos(F.lit(2 * math.pi) * col_(x) / F.lit(float(period)))


def whole_weeks_since(d: str | Column, origin: str | Column) -> Column:
    """Completed weeks between ``origin`` and ``d`` (truncated)."""
    return F.floor(F.datediff(col_(d), col_(origin)) / F.lit(7)).cast("int")


def week_start(ts: str | Column) -> Column:
    """Monday of the ISO week holding ``ts``, as a date (no time-zone shift)."""
    return F.trunc(col_(ts).cast("date"), "week")
