"""Feature engineering on the store-week table.

Global scalars come from one-row aggregates: the first date is an
uncorrelated scalar subquery (run once, used as a literal), the size
moments a broadcast one-row cross join. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import LAGS, ROLLING_WINDOWS, TYPE_CODES
from ..functions import calendar as cal
from ..functions.nulls import safe_div
from .common import attach_scalars

LAG_ORDER = ("Date", "IsHoliday", "Type", "Size")


def first_date(df: DataFrame, date_col: str = "Date") -> DataFrame:
    return df.agg(F.min(date_col).alias("first_date"))


def time_columns(d: F.Column, origin: F.Column) -> dict[str, F.Column]:
    """year, month, ISO week, quarter, month-end flag, sin/cos cycles, trend."""
    week, month = cal.iso_week(d), cal.month(d)
    return {
        "year": cal.year(d), "month": month, "week_of_year": week, "quarter": cal.quarter(d), "is_month_end": cal.is_month_end(d),
        "week_sin": cal.cyclic_sin(week, 52), "week_cos": cal.cyclic_cos(week, 52),
        "month_sin": cal.cyclic_sin(month, 12), "month_cos": cal.cyclic_cos(month, 12),
        "trend": cal.whole_weeks_since(d, origin),
    }


def store_columns(strict: bool) -> dict[str, F.Column]:
    """type_code and size_norm, from ``size_mean`` and ``size_std`` columns."""
    return {"type_code": type_code("Type", strict), "size_norm": safe_div(F.col("Size") - F.col("size_mean"), F.col("size_std"))}


def add_time_features(df: DataFrame, date_col: str = "Date") -> DataFrame:
    return df.withColumns(time_columns(F.col(date_col), first_date(df, date_col).scalar()))


def type_code(type_col: str = "Type", strict: bool = True):
    """A -> 0, B -> 1, C -> 2. Anything else raises (strict) or is NULL."""
    t = F.col(type_col)
    expr = None
    for letter, code in TYPE_CODES.items():
        expr = (F.when(t == letter, F.lit(code)) if expr is None else expr.when(t == letter, F.lit(code)))
    if strict:
        expr = expr.otherwise(F.raise_error(F.concat(F.lit("unknown store type: "), F.coalesce(t, F.lit("NULL")))))
    return expr.cast("int")


def size_moments(df: DataFrame, size_col: str = "Size") -> DataFrame:
    """Mean and sample std of size over the rows of ``df`` (weighted by weeks)."""
    return df.agg(F.avg(size_col).alias("size_mean"), F.stddev_samp(size_col).alias("size_std"))


def add_store_features(df: DataFrame, strict: bool = True, moments_from: DataFrame | None = None) -> DataFrame:
    """type_code and size_norm = (Size - mean) / std; std 0 gives NULL.

    ``moments_from`` lets the moments come from another frame (e.g. train
    rows only); by default they come from ``df`` itself.
    """
    m = size_moments(moments_from if moments_from is not None else df)
    return attach_scalars(df, m).withColumns(store_columns(strict)).drop("size_mean", "size_std")


def lag_window(df: DataFrame, group_col: str = "Store", order_cols: Sequence[str] = LAG_ORDER):
    order = [c for c in order_cols if c in df.columns]
    return Window.partitionBy(group_col).orderBy(*order)


def add_lag_features(
    df: DataFrame,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = ROLLING_WINDOWS,
    group_col: str = "Store",
    sales_col: str = "Weekly_Sales",
    order_cols: Sequence[str] = LAG_ORDER,
) -> DataFrame:
    """Per-group lags (by row, not by calendar) and trailing means.

    ``sales_roll_k`` is the mean of the previous k rows, excluding the
    current one, with at least one value. All columns share one window
    spec, so the plan has one exchange, one sort and one Window node. A
    group holds one row per week, so its size is bounded by the calendar,
    not by the data volume.
    """
    w = lag_window(df, group_col, order_cols)
    cols = {f"sales_lag_{k}": F.lag(sales_col, k).over(w) for k in lags}
    for k in windows:
        cols[f"sales_roll_{k}"] = F.avg(sales_col).over(w.rowsBetween(-k, -1))
    return df.withColumns(cols)


def prepare_features(
    df: DataFrame, strict: bool = True, lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING_WINDOWS, sales_col: str = "Weekly_Sales",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Calendar, store and lag features on the whole store-week table.

    The three global scalars (first date, size mean and std) come from one
    one-row aggregate attached once, so ``df`` is read twice: once for the
    scalars and once for the rows. Materialise ``df`` first when it is
    expensive to recompute (the pipeline does). ``fit_on`` (e.g. the training
    rows) gives the size moments instead of ``df``.
    """
    first, moments = F.min("Date").alias("_first_date"), (F.avg("Size").alias("size_mean"), F.stddev_samp("Size").alias("size_std"))
    out = attach_scalars(df, df.agg(first, *moments)) if fit_on is None else attach_scalars(attach_scalars(df, df.agg(first)), fit_on.agg(*moments))
    out = out.withColumns(time_columns(F.col("Date"), F.col("_first_date")) | store_columns(strict))
    return add_lag_features(out.drop("_first_date", "size_mean", "size_std"), lags, windows, sales_col=sales_col)
