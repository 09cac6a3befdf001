"""Inventory formulas as column expressions (continuous review, (s, Q)).

    safety stock  SS  = z * sigma * sqrt(L)
    reorder point ROP = mu * L + SS
    EOQ               = sqrt(2 * D * K / h),  D = 52 * mu,  h = pct * value
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import WEEKS_PER_YEAR
from .nulls import col_, safe_div


def safety_stock(std: str | Column, lead_time_weeks: float, z: float) -> Column:
    return F.lit(float(z)) * col_(std) * F.lit(math.sqrt(lead_time_weeks))


def reorder_point(avg: str | Column, std: str | Column, lead_time_weeks: float, z: float) -> Column:
    return col_(avg) * F.lit(float(lead_time_weeks)) + safety_stock(std, lead_time_weeks, z)


def eoq(avg_weekly: str | Column, ordering_cost: float, unit_value: float, holding_cost_pct: float) -> Column:
    """0 when demand or holding cost is not positive; missing demand stays missing."""
    annual = col_(avg_weekly) * F.lit(float(WEEKS_PER_YEAR))
    h = float(holding_cost_pct) * float(unit_value)
    if h <= 0:
        return F.when(annual.isNull(), F.lit(None).cast("double")).otherwise(F.lit(0.0))
    return F.when(annual <= 0, F.lit(0.0)).otherwise(
        F.sqrt(safe_div(F.lit(2.0) * annual * F.lit(float(ordering_cost)), F.lit(h)))
    )


def recommended_order_qty(demand: str | Column, safety: str | Column, lead_time_weeks: float, review_weeks: float) -> Column:
    """Cover lead time plus one review period at ``demand``, plus safety stock."""
    return col_(demand) * F.lit(float(lead_time_weeks + review_weeks)) + col_(safety)


def replenishment_alert(forecast: str | Column, history: str | Column, threshold: float) -> Column:
    """Forecast strictly above threshold x history; missing is no alert."""
    return F.coalesce(col_(forecast) > col_(history) * F.lit(float(threshold)), F.lit(False))
