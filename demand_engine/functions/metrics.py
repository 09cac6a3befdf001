"""Forecast accuracy as aggregate expressions (usable in ``agg``).

All four are algebraic, so Spark computes them with a map-side partial
aggregate and a tiny final merge, in one pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import MAPE_EPS
from .nulls import col_, safe_div


def mae(actual: str | Column, predicted: str | Column) -> Column:
    return F.avg(F.abs(col_(actual) - col_(predicted)))


def rmse(actual: str | Column, predicted: str | Column) -> Column:
    err = col_(actual) - col_(predicted)
    return F.sqrt(F.avg(err * err))


def mape(actual: str | Column, predicted: str | Column, eps: float = MAPE_EPS) -> Column:
    """Percent error over rows with |actual| > eps; NULL when there are none."""
    a, p = col_(actual), col_(predicted)
    return F.lit(100.0) * F.avg(F.when(F.abs(a) > F.lit(eps), F.abs(safe_div(a - p, a))))


def r2(actual: str | Column, predicted: str | Column) -> Column:
    """1 - SS_res / SS_tot; NULL when the actuals do not vary."""
    a, p = col_(actual), col_(predicted)
    err = a - p
    ss_tot = F.var_pop(a) * F.count(a)
    return F.when(ss_tot > 0, F.lit(1.0) - safe_div(F.sum(err * err), ss_tot))
