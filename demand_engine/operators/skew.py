"""Left join that keeps its tasks even where a few keys hold most rows and
the other side is too large to broadcast."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the right side that may be broadcast for the heavy keys.
MAX_BROADCAST_ROWS = 200_000
#: A heavy key's rows are dealt into pieces of this share of a task's rows.
PIECES_PER_TASK = 4


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """(key, n, total): all values of ``key`` that hold ``share`` of the rows
    with a key, or nearly so, with a count never too small; at most
    1 / ``share`` or so of them.

    One pass with a sketch whose size follows ``share`` only: it tracks
    8 / ``share`` values, so counts are off by less than half of ``share``.
    """
    k = math.ceil(1 / share)
    tracked = min(1_000_000, 8 * k)
    keyed = df.where(F.col(key).isNotNull())
    top = keyed.agg(F.expr(f"approx_top_k(`{key}`, {min(2 * k, tracked)}, {tracked})").alias("top"), F.count(F.lit(1)).alias("total"))
    found = top.select("total", F.inline("top")).select(F.col("item").alias(key), F.col("count").alias("n"), "total")
    return found.where(F.col("n") >= F.lit(share) * F.col("total"))


def skewed_left_join(left: DataFrame, right: DataFrame, key: str, share: float | None = None, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``left.join(right, key, "left")`` with heavy keys apart.

    Keys that hold ``share`` of the left rows (default: half of a shuffle
    task's) are found by a sketch. The right rows of those keys are broadcast
    where they are at most ``max_broadcast_rows``, so that the left rows stay
    where they were read. Beyond that, the left rows of a heavy key are dealt
    into pieces and the right rows of that key copied to each piece; a key's
    pieces follow its share, so all copies together are about
    ``PIECES_PER_TASK`` for each task. All other keys are shuffled.

    Rows without a key match nothing and are never shuffled by it (a plain
    left join sends all of them to one task). Right rows may repeat a key;
    an empty side is allowed; other columns must differ in name. Runs two
    small jobs (heavy keys, their right rows) when it is called.
    """
    clash = sorted(set(left.columns) & set(right.columns) - {key})
    if clash:
        raise ValueError(f"columns in both tables: {clash}")
    spark = left.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = share or min(1.0, 1 / (2 * tasks))
    found = heavy_keys(left, key, share).collect()  # at most 1 / share rows
    marks = spark.createDataFrame(
        [(r[key], max(1, math.ceil(PIECES_PER_TASK * tasks * r["n"] / r["total"]))) for r in found],
        left.select(key, F.lit(0).alias("_pieces")).schema,
    )
    columns = [*left.columns, *(c for c in right.columns if c != key)]
    marked = left.join(F.broadcast(marks), key, "left")
    light = left.where(F.col(key).isNotNull()).join(F.broadcast(marks), key, "left_anti")
    rest = light.join(right.join(F.broadcast(marks), key, "left_anti"), key, "left")
    heavy = marked.where(F.col("_pieces").isNotNull() | F.col(key).isNull())
    theirs = right.join(F.broadcast(marks), key)
    if theirs.limit(max_broadcast_rows + 1).count() <= max_broadcast_rows:
        joined = heavy.join(F.broadcast(theirs.drop("_pieces")), key, "left")
    else:
        # the place of a row in its input is part of the salt: repeated rows are dealt too
        salt = F.pmod(F.xxhash64(*left.columns, F.spark_partition_id()), F.coalesce("_pieces", F.lit(PIECES_PER_TASK * tasks)))
        copies = theirs.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_pieces").cast("long") - 1))).drop("_pieces")
        joined = heavy.withColumn("_salt", salt).join(copies, [key, "_salt"], "left")
    return joined.select(*columns).unionByName(rest.select(*columns))
