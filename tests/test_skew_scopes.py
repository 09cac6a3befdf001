"""The store join with heavy stores apart, and the lifetime of shared tables."""

import os
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from demand_engine.operators.clean import enrich_stores, enrich_stores_skewed
from demand_engine.operators.skew import heavy_keys, skewed_left_join
from demand_engine.plans.pipeline import PipelineConfig, run_pipeline
from demand_engine.session import materialize, settled, shared_path, table_scope
from demand_engine.sources import load_raw_data

N, STORES = 90_000, 4_000


@pytest.fixture
def no_broadcast(spark):
    """Nothing is broadcast by size, and partitions are not merged."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    spark.conf.set(names[0], "-1")
    spark.conf.set(names[1], "false")
    yield
    for n, v in zip(names, before, strict=True):
        spark.conf.set(n, v)


def tables(spark, copies=1):
    """A third of the sales in store 7; every tenth of the others without a
    store, some of unknown stores, and rows that repeat."""
    i = F.col("id")
    store = F.when(i % 3 == 0, 7).when(i % 10 == 1, None).otherwise(100 + i % (STORES + 50)).cast("long")
    sales = spark.range(0, N, 1, 8).select(store.alias("Store"), (i % 500).alias("Week"), (i % 11).cast("double").alias("Weekly_Sales"))
    stores = spark.range(0, STORES + 100, 1, 4).select(i.alias("Store"), F.concat(F.lit("T"), i % 3).alias("Type"))
    return sales, stores.withColumn("Version", F.explode(F.sequence(F.lit(1), F.when(F.col("Store") == 7, copies).otherwise(1))))


def loads(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def same_rows(a, b):
    assert a.columns == b.columns
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_heavy_keys_are_all_found(spark):
    sales, _ = tables(spark)
    got = {r["Store"]: (r["n"], r["total"]) for r in heavy_keys(sales, "Store", 1 / 16).collect()}
    n, total = got.pop(7)
    assert not got and total == sales.where("Store is not null").count() and N / 3 <= n <= N / 3 + total / 32


def test_tasks_stay_even_with_a_third_on_one_store(spark, no_broadcast):
    sales, stores = tables(spark)
    got = loads(enrich_stores_skewed(sales, stores))
    assert sum(got) == N and max(got) <= 2 * median(got)
    assert max(loads(enrich_stores(sales, stores))) > 2 * median(got)  # the plain join has a hot task


@pytest.mark.parametrize("limit", [200_000, 3])
def test_rows_equal_the_plain_join(spark, no_broadcast, limit):
    sales, stores = tables(spark, copies=5)
    out = skewed_left_join(sales, stores, "Store", max_broadcast_rows=limit)
    plain = sales.join(stores, "Store", "left")
    key = [F.count("*").alias("n"), F.sum(F.xxhash64(*plain.columns).cast("decimal(38,0)")).alias("h"), F.count("Type").alias("t")]
    assert out.columns == plain.columns and out.agg(*key).first() == plain.agg(*key).first()


def test_dealt_pieces_spread_a_heavy_store(spark, no_broadcast):
    """Where its right rows are too many to broadcast."""
    sales, stores = tables(spark, copies=5)
    dealt, plain = (loads(x) for x in (skewed_left_join(sales, stores, "Store", max_broadcast_rows=3), sales.join(stores, "Store", "left")))
    assert sum(dealt) == sum(plain) and max(dealt) < max(plain) / 2


def test_empty_sides_and_clashing_names(spark):
    sales, stores = tables(spark)
    none = sales.limit(0)
    assert skewed_left_join(none, stores, "Store").count() == 0
    few = spark.createDataFrame([(1, 1), (1, 1), (None, 2)], "Store long, Week long")
    same_rows(skewed_left_join(few, stores.limit(0), "Store"), few.join(stores.limit(0), "Store", "left"))
    same_rows(skewed_left_join(few, stores, "Store"), few.join(stores, "Store", "left"))
    with pytest.raises(ValueError, match="Week"):
        skewed_left_join(few, stores.withColumn("Week", F.lit(1)), "Store")


def left_over(spark):
    folder = shared_path(spark, "tables").removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_scopes_delete_what_was_written_in_them(spark):
    before = left_over(spark)
    with pytest.raises(RuntimeError, match="stop"), table_scope(spark):
        materialize(spark.range(3), "outer")
        with table_scope(spark):
            materialize(spark.range(3), "inner")
            assert len(left_over(spark) - before) == 2
        assert len(left_over(spark) - before) == 1
        raise RuntimeError("stop")
    assert left_over(spark) == before


def test_settled_tables_outlive_only_their_steps(spark):
    before = left_over(spark)
    with table_scope(spark):
        def step(n):
            return spark.range(5) if n == 0 else settled(spark, lambda: materialize(step(n - 1)).withColumn(f"c{n}", F.lit(n)), f"step{n}")

        out = step(3)
        assert out.count() == 5 and out.columns == ["id", "c1", "c2", "c3"]
        assert {x.split("-")[0] for x in left_over(spark) - before} == {"step3"}
    assert left_over(spark) == before


def test_a_demand_run_leaves_nothing(spark, sf_small):
    before = left_over(spark)
    with table_scope(spark):
        out = run_pipeline(*load_raw_data(spark, sf_small), PipelineConfig(models=("naive",)))
        assert out["inventory_plan"].count() and left_over(spark) - before
    assert left_over(spark) == before
