"""Distributed suffix sums over a keyed table, without a one-task window.

``Window.orderBy(...)`` with no partition moves every row into one task.
Here the table is range-partitioned on the key and written once with its
bucket number; bucket totals (one row per partition, so bounded by the
partition count) give each bucket its offset, and a window inside each
bucket finishes the job. Range bounds come from a sample, so the buckets
must not be computed twice: both sides read the written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def range_buckets(df: DataFrame, keys: Sequence[str], n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``_bucket``, written once: buckets are ranges of the keys."""
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *(F.col(k).asc() for k in keys)).withColumn("_bucket", F.spark_partition_id()), "ranges")


def suffix_sum(df: DataFrame, key: str, value: str, out_col: str, n_buckets: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``value`` over rows whose ``key`` is strictly greater.

    ``key`` must be unique in ``df`` (e.g. a table of per-key counts).
    """
    ranged = range_buckets(df, [key], n_buckets)
    totals = ranged.groupBy("_bucket").agg(F.sum(value).alias("_bucket_total"))
    later = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", F.coalesce(F.sum("_bucket_total").over(later), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy(F.desc(key)).rowsBetween(Window.unboundedPreceding, -1)
    # ``offsets`` has one row per bucket: its size is bounded by ``n_buckets``.
    return (
        ranged.join(F.broadcast(offsets), "_bucket")
        .withColumn(out_col, F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_bucket", "_offset")
    )


def running_count(df: DataFrame, group: str, value: str, count: str, out_col: str, n_buckets: int | None = None) -> DataFrame:
    """Add ``out_col`` = sum of ``count`` over the group's rows with ``value``
    up to the row's own. (``group``, ``value``) must be unique. A group that
    holds most rows is spread over many buckets by its values."""
    ranged = range_buckets(df, [group, value], n_buckets)
    totals = ranged.groupBy(group, "_bucket").agg(F.sum(count).alias("_part"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(group, "_bucket", F.coalesce(F.sum("_part").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket", group).orderBy(value)
    return (
        ranged.join(offsets, [group, "_bucket"])
        .withColumn(out_col, F.col("_offset") + F.sum(count).over(inside))
        .drop("_bucket", "_offset")
    )
