"""Profiles and data-quality counts (one-row aggregates)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import safe_div


def dataset_profile(store_weekly: DataFrame, date_col: str = "Date", group_col: str = "Store") -> DataFrame:
    return store_weekly.agg(
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.count_distinct(group_col).alias("n_stores"),
        F.count_distinct(date_col).alias("n_weeks"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def raw_profile(sales: DataFrame, stores: DataFrame, group_col: str = "Store") -> DataFrame:
    a = sales.agg(F.count(F.lit(1)).alias("n_sales_rows"))
    b = stores.agg(F.count_distinct(group_col).alias("n_stores"))
    return a.crossJoin(b)  # two one-row aggregates


def negative_sales_profile(sales: DataFrame, sales_col: str = "Weekly_Sales") -> DataFrame:
    """Rows removed by cleaning (negative, missing or NaN) and their share in percent."""
    ws = F.col(sales_col)
    kept = F.coalesce((ws >= 0) & ~F.isnan(ws), F.lit(False))
    prof = sales.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~kept).alias("n_dropped"))
    return prof.withColumn("pct_dropped", F.round(F.lit(100.0) * safe_div(F.col("n_dropped").cast("double"), F.col("n_rows")), 4))


def split_profile(train: DataFrame, holdout: DataFrame, cutoff: DataFrame) -> DataFrame:
    """Row counts of both sides with the cutoff and the last dataset date before it."""
    t = train.agg(F.count(F.lit(1)).alias("train_rows"))
    h = holdout.agg(F.count(F.lit(1)).alias("holdout_rows"))
    return t.crossJoin(h).crossJoin(cutoff.select("last_train_date", "cutoff_date"))
