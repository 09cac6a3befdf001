"""The store-week aggregate over a stream of sales rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import STORE_WEEK_KEYS, clean_sales


def store_weekly_stream(sales_stream: DataFrame, stores: DataFrame, lateness: str,
                        sales_col: str = "Weekly_Sales") -> DataFrame:
    """``build_store_weekly`` on a streaming ``sales`` frame: the same rows as
    long as no row arrives more than ``lateness`` behind the latest date seen;
    later ones are dropped by the watermark.

    The static ``stores`` side is joined without state (stream-static inner
    join); the sum is keyed by the five store-week keys plus the week start as
    event time, and the watermark lets Spark drop a week's state once rows
    for it can no longer arrive. In ``append`` mode a store-week is emitted
    once, when the watermark passes it; ``update`` emits running sums.
    """
    clean = clean_sales(sales_stream, sales_col).filter(
        F.col("Store").isNotNull() & F.col("Date").isNotNull() & F.col("IsHoliday").isNotNull()
    )
    timed = clean.withColumn("week_ts", F.col("Date").cast("timestamp")).withWatermark("week_ts", lateness)
    dims = stores.filter(F.col("Type").isNotNull() & F.col("Size").isNotNull()).select("Store", "Type", "Size")
    return (
        timed.join(dims, "Store", "inner")
        .groupBy("week_ts", *STORE_WEEK_KEYS)
        .agg(F.sum(sales_col).alias(sales_col))
        .drop("week_ts")
    )
