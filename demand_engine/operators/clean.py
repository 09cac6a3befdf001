"""Cleaning, the store join and the store-week aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import skewed_left_join

SALES_KEYS = ["Store", "Date", "IsHoliday"]
STORE_WEEK_KEYS = ["Store", "Date", "IsHoliday", "Type", "Size"]


def clean_sales(sales: DataFrame, sales_col: str = "Weekly_Sales") -> DataFrame:
    """Keep rows with sales >= 0. Zero stays; NULL, NaN and negatives go."""
    ws = F.col(sales_col)
    return sales.filter((ws >= 0) & ~F.isnan(ws))


def enrich_stores(sales: DataFrame, stores: DataFrame, key: str = "Store") -> DataFrame:
    """Left join of store attributes onto sales (many rows per store allowed).

    No broadcast hint: the optimizer broadcasts ``stores`` when its estimated
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks
    with the real size; a large dimension falls back to a shuffle join.
    """
    return sales.join(stores, key, "left")


def enrich_stores_skewed(sales: DataFrame, stores: DataFrame, key: str = "Store", share: float | None = None) -> DataFrame:
    """``enrich_stores`` for a store table too large to broadcast and a few
    stores that hold most sales rows (see ``skew.skewed_left_join``)."""
    return skewed_left_join(sales, stores, key, share)


def _complete_stores(stores: DataFrame) -> DataFrame:
    """Store rows that can form a group key (grouping drops missing keys)."""
    return stores.filter(F.col("Store").isNotNull() & F.col("Type").isNotNull() & F.col("Size").isNotNull())


def build_store_weekly(sales: DataFrame, stores: DataFrame, sales_col: str = "Weekly_Sales") -> DataFrame:
    """Clean, attach store attributes and sum to one row per store-week.

    Output: Store, Date, IsHoliday, Type, Size, Weekly_Sales.

    Plan: the sales sum is pre-aggregated on (Store, Date, IsHoliday) before
    the join, so the raw fact rows are never shuffled -- only map-side
    partial sums are. A hot store is spread over its weeks by that key.
    The join then sees one row per store-week; the second sum (on the five
    keys) only matters when a store appears twice in ``stores`` and needs no
    new shuffle, since its keys contain the join's partitioning key.
    Rows whose store is unknown, or with any missing key, drop out, as a
    group-by on missing keys would drop them.
    """
    clean = clean_sales(sales, sales_col).filter(
        F.col("Store").isNotNull() & F.col("Date").isNotNull() & F.col("IsHoliday").isNotNull()
    )
    per_week = clean.groupBy(*SALES_KEYS).agg(F.sum(sales_col).alias("_ws"))
    joined = per_week.join(_complete_stores(stores).select("Store", "Type", "Size"), "Store", "inner")
    return joined.groupBy(*STORE_WEEK_KEYS).agg(F.sum("_ws").alias(sales_col))


def duplicated_stores(stores: DataFrame) -> DataFrame:
    """(Store, n) of the stores with more than one row; their sales would be
    summed once for each."""
    return stores.groupBy("Store").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any column."""
    return df.na.drop(how="any")
