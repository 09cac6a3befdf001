"""Distributed running sums against brute force, with and without exchange reuse."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.operators.prefix import running_count, suffix_sum


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_suffix_sum_on_a_million_keys(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).alias("k"), (F.col("id") % 11).alias("v"))
        got = suffix_sum(df, "k", "v", "after", 8).toPandas().sort_values("k")
        total = got["v"].sum()
        expected = total - np.cumsum(got["v"].to_numpy())
        np.testing.assert_array_equal(got["after"].to_numpy(), expected)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_running_count_with_one_large_group(spark):
    rows = [("A", float(i), 1 + i % 3) for i in range(5000)] + [("B", 1.0, 2), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "g string, v double, c long")
    got = {(r["g"], r["v"]): r["upto"] for r in running_count(df, "g", "v", "c", "upto", 8).collect()}
    total = 0
    for g, v, c in rows[:5000]:
        total += c
        assert got[g, v] == total
    assert got["B", 1.0] == 2
