import math

import pytest
from pyspark.sql import functions as F

from demand_engine.config import InventoryParams
from demand_engine.functions import inventory as inv
from demand_engine.operators.inventory import (
    build_inventory_plan,
    compute_demand_stats,
    replenishment_alerts,
    summarise_inventory,
)


def _scalar(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()["x"]


class TestInventory:
    def test_safety_stock_zero_std(self, spark):
        assert _scalar(spark, inv.safety_stock(F.lit(0.0), 2, 1.645)) == pytest.approx(0.0)

    def test_safety_stock_known(self, spark):
        assert _scalar(spark, inv.safety_stock(F.lit(100.0), 4, 1.645)) == pytest.approx(329.0, rel=1e-3)

    def test_reorder_point_equals_demand_plus_ss(self, spark):
        ss = _scalar(spark, inv.safety_stock(F.lit(50.0), 2, 1.645))
        rop = _scalar(spark, inv.reorder_point(F.lit(200.0), F.lit(50.0), 2, 1.645))
        assert rop == pytest.approx(200 * 2 + ss, rel=1e-6)

    def test_eoq_positive(self, spark):
        q = _scalar(spark, inv.eoq(F.lit(1000.0), 150, 25, 0.2))
        assert q > 0
        assert q == pytest.approx(math.sqrt(2 * 52 * 1000 * 150 / 5.0))

    def test_eoq_zero_demand(self, spark):
        assert _scalar(spark, inv.eoq(F.lit(0.0), 150, 25, 0.2)) == pytest.approx(0.0)

    def test_compute_demand_stats_shape(self, spark):
        df = spark.createDataFrame([(1, 100.0), (1, 200.0), (2, 300.0), (2, 400.0)], "Store long, Weekly_Sales double")
        stats = compute_demand_stats(df)
        assert stats.count() == 2
        assert {"avg_weekly_demand", "std_weekly_demand", "n_weeks", "cv"} <= set(stats.columns)
        r = stats.filter("Store = 1").first()
        assert r["avg_weekly_demand"] == 150.0 and r["std_weekly_demand"] == pytest.approx(70.7106781)
        assert r["cv"] == 0.471

    def test_build_inventory_plan_columns(self, spark):
        stats = spark.createDataFrame([(1, 1000.0, 200.0, 52, 0.2)],
                                      "Store long, avg_weekly_demand double, std_weekly_demand double, n_weeks long, cv double")
        plan = build_inventory_plan(stats, None, InventoryParams(z_score=1.645))
        for col in ("safety_stock", "reorder_point", "eoq", "recommended_order_qty", "replenishment_alert"):
            assert col in plan.columns
        r = plan.first()
        assert r["safety_stock"] == round(1.645 * 200 * math.sqrt(2), 2)
        assert r["recommended_order_qty"] == round(1000 * 6 + r["safety_stock"], 2)
        assert r["replenishment_alert"] is False


STATS_SCHEMA = "Store long, avg_weekly_demand double, std_weekly_demand double, n_weeks long, cv double"


def test_forecast_missing_store_uses_history(spark):
    stats = spark.createDataFrame([(1, 1000.0, 100.0, 10, 0.1), (2, 500.0, 50.0, 10, 0.1)], STATS_SCHEMA)
    fc = spark.createDataFrame([(1, 1200.0), (1, 1400.0)], "Store long, predicted double")
    rows = {r["Store"]: r for r in build_inventory_plan(stats, fc).collect()}
    assert rows[1]["forecast_avg_demand"] == 1300.0 and rows[1]["demand_used"] == 1300.0
    assert rows[1]["replenishment_alert"] is True
    assert rows[2]["forecast_avg_demand"] is None and rows[2]["demand_used"] == 500.0
    assert rows[2]["replenishment_alert"] is False


def test_forecast_at_threshold_is_strict(spark):
    stats = spark.createDataFrame([(s, 1000.0, 100.0, 10, 0.1) for s in (1, 2, 3)], STATS_SCHEMA)
    fc = spark.createDataFrame([(1, 1099.0), (2, 1100.0), (3, 1101.0)], "Store long, predicted double")
    rows = {r["Store"]: r["replenishment_alert"] for r in build_inventory_plan(stats, fc).collect()}
    assert rows == {1: False, 2: False, 3: True}


def test_single_week_store_propagates_null(spark):
    df = spark.createDataFrame([(7, 500.0)], "Store long, Weekly_Sales double")
    r = build_inventory_plan(compute_demand_stats(df)).first()
    assert r["std_weekly_demand"] is None
    assert r["safety_stock"] is None and r["reorder_point"] is None
    assert r["eoq"] == pytest.approx(round(math.sqrt(2 * 52 * 500 * 150 / 5.0), 2))


def test_alerts_and_summary(spark):
    stats = spark.createDataFrame([(1, 1000.0, 100.0, 10, 0.1), (2, 500.0, 50.0, 10, 0.1)], STATS_SCHEMA)
    fc = spark.createDataFrame([(1, 2000.0), (2, 500.0)], "Store long, predicted double")
    plan = build_inventory_plan(stats, fc)
    assert [r["Store"] for r in replenishment_alerts(plan).collect()] == [1]
    s = summarise_inventory(plan).first()
    assert s["n_stores"] == 2 and s["n_alerts"] == 1


def test_z_score_constant():
    from demand_engine.config import z_score

    assert z_score(0.95) == 1.6449
