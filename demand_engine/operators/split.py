"""Train / holdout split by date, and the validation rows for early stopping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import HOLDOUT_WEEKS, VALIDATION_FRACTION
from .clean import drop_incomplete
from .prefix import suffix_sum


def cutoff_info(df: DataFrame, holdout_weeks: int = HOLDOUT_WEEKS, date_col: str = "Date") -> DataFrame:
    """One row: ``cutoff_date`` (the k-th distinct date from the end) and
    ``last_train_date`` (the distinct date just before it).

    Only the k+1 latest distinct dates reach the driver-side plan
    (``TakeOrderedAndProject``), so this stays small at any scale. Fewer
    than k+1 distinct dates is an error raised when the plan runs.
    """
    k = int(holdout_weeks)
    if k < 1:
        raise ValueError("holdout_weeks must be at least 1")
    latest = df.select(date_col).distinct().orderBy(F.desc(date_col)).limit(k + 1)
    info = latest.agg(F.sort_array(F.collect_list(date_col)).alias("_d"), F.count(F.lit(1)).alias("_n"))
    ok = F.col("_n") > k
    err = F.raise_error(F.format_string(f"holdout_weeks={k} needs more than {k} distinct dates, found %d", F.col("_n")))
    return info.select(
        F.when(ok, F.col("_d")[1]).otherwise(err).alias("cutoff_date"),
        F.when(ok, F.col("_d")[0]).otherwise(err).alias("last_train_date"),
    )


def cutoff_date(df: DataFrame, holdout_weeks: int = HOLDOUT_WEEKS, date_col: str = "Date") -> DataFrame:
    return cutoff_info(df, holdout_weeks, date_col).select("cutoff_date")


def train_rows(df: DataFrame, cutoff, date_col: str = "Date") -> DataFrame:
    return df.filter(F.col(date_col) < cutoff)


def holdout_rows(df: DataFrame, cutoff, date_col: str = "Date") -> DataFrame:
    return df.filter(F.col(date_col) >= cutoff)


def train_holdout_split(
    df: DataFrame, holdout_weeks: int = HOLDOUT_WEEKS, date_col: str = "Date", cutoff=None
) -> tuple[DataFrame, DataFrame]:
    """Dates before the cutoff train, the rest hold out; incomplete rows drop.

    ``cutoff`` may be given (a date or Column); by default it is the
    k-th distinct date from the end, as a scalar subquery.
    """
    if cutoff is None:
        cutoff = cutoff_date(df, holdout_weeks, date_col).scalar()
    elif not isinstance(cutoff, F.Column):
        cutoff = F.lit(cutoff)
    return (
        drop_incomplete(train_rows(df, cutoff, date_col)),
        drop_incomplete(holdout_rows(df, cutoff, date_col)),
    )


def validation_flag(
    train: DataFrame,
    fraction: float = VALIDATION_FRACTION,
    mode: str = "chronological",
    group_col: str = "Store",
    date_col: str = "Date",
    order_cols: tuple[str, ...] = ("IsHoliday", "Type", "Size"),
    out_col: str = "is_validation",
) -> DataFrame:
    """Mark about ``fraction`` of the training rows (at least one) as validation.

    ``chronological``: the latest whole dates whose rows first reach
    ``max(1, int(fraction * n))``.
    ``tail_rows``: exactly the last ``max(1, int(fraction * n))`` rows in
    (group, date, ...) order -- i.e. the highest group keys, as a
    positional tail of a store-sorted table would be.
    Neither mode sorts the whole table. ``chronological`` windows over the
    per-date counts (one row per week); ``tail_rows`` needs a running sum
    over per-store counts, which grow with the data, so it uses the
    range-bucketed suffix sum of ``prefix.suffix_sum``.
    """
    if mode == "chronological":
        # One row per distinct date: bounded by the calendar, not by the data,
        # so an unpartitioned window over it is small at any scale.
        per_date = train.groupBy(date_col).agg(F.count(F.lit(1)).alias("_c"))
        later = Window.orderBy(F.desc(date_col)).rowsBetween(Window.unboundedPreceding, -1)
        need = F.greatest(F.lit(1), F.floor(F.sum("_c").over(Window.partitionBy()) * F.lit(float(fraction))).cast("long"))
        cum = per_date.select(date_col, "_c", F.coalesce(F.sum("_c").over(later), F.lit(0)).alias("_after"),
                              need.alias("_need"))
        boundary = cum.filter((F.col("_after") < F.col("_need")) & (F.col("_after") + F.col("_c") >= F.col("_need"))) \
            .agg(F.max(date_col)).scalar()
        return train.withColumn(out_col, F.coalesce(F.col(date_col) >= boundary, F.lit(False)))
    n_val = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) * F.lit(float(fraction))).cast("long"))
    need = train.agg(n_val.alias("n_val")).scalar()
    if mode == "tail_rows":
        per_group = train.groupBy(group_col).agg(F.count(F.lit(1)).alias("_c"))
        offsets = suffix_sum(per_group, group_col, "_c", "_after").select(group_col, "_after")
        order = [F.desc(c) for c in (date_col, *order_cols) if c in train.columns]
        w = Window.partitionBy(group_col).orderBy(*order)
        return (
            train.join(offsets, group_col, "left")
            .withColumn(out_col, (F.row_number().over(w) + F.col("_after")) <= need)
            .drop("_after")
        )
    raise ValueError(f"unknown validation mode {mode!r}")
