"""The whole run: parameters, outputs, command line and report."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.config import InventoryParams
from demand_engine.operators.evaluation import rmse_vs_baseline
from demand_engine.plans.pipeline import BASELINE_MODELS, PipelineConfig, run_pipeline, write_outputs
from demand_engine.sources import load_raw_data


def test_window_and_target_parameters(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    cfg = PipelineConfig(models=("naive", "moving_average", "ridge"), ma_window=8, target="Sales", inventory=InventoryParams(service_level=0.99))
    out = run_pipeline(sales.withColumnRenamed("Weekly_Sales", "Sales"), stores, cfg)
    assert {r["Model"] for r in out["model_comparison"].collect()} == {"Naive (Last Value)", "Moving Average (8w)", "Ridge Regression"}
    base = run_pipeline(sales, stores, PipelineConfig(models=BASELINE_MODELS))
    high, low = (o["inventory_plan"].agg(F.avg("safety_stock")).first()[0] for o in (out, base))
    assert high > low
    assert out["sales_by_type"].count() == 3 and out["demand_trend"].count() > 0


def test_scalars_from_training_rows_and_duplicate_stores(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    cfg = PipelineConfig(models=("naive",), fit_on="train", unique_stores=True)
    out = run_pipeline(sales, stores, cfg)
    cut = out["train"].agg(F.max("Date")).first()[0]
    m = out["store_weekly"].filter(F.col("Date") <= cut).agg(F.avg("Size").alias("m"), F.stddev_samp("Size").alias("s")).first()
    row = out["train"].first()
    assert row["size_norm"] == pytest.approx((row["Size"] - m["m"]) / m["s"], rel=1e-3, abs=1e-3)
    with pytest.raises(ValueError, match="several rows"):
        run_pipeline(sales, stores.union(stores.limit(1)), cfg)


def test_constant_size_warns(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    with pytest.warns(UserWarning, match="one size"):
        run_pipeline(sales, stores.withColumn("Size", F.lit(5).cast("long")), PipelineConfig(models=("naive",)))


def test_rmse_against_a_named_model(spark):
    df = spark.createDataFrame([("a", 10.0), ("b", 8.0), ("c", 12.0)], "Model string, RMSE double")
    got = {r["Model"]: r["rmse_vs_baseline_pct"] for r in rmse_vs_baseline(df, "a").collect()}
    assert got == {"a": 0.0, "b": 20.0, "c": -20.0}


def test_outputs_and_command_line(spark, sf_small, tmp_path, capsys):
    from demand_engine.__main__ import main

    assert main(["--sf-dir", sf_small, "--out", str(tmp_path / "out"), "--models", "naive,moving_average", "--service-level", "0.9"]) == 0
    text = capsys.readouterr().out
    assert "service level of 90%" in text and "under the worst" in text
    for name in ("inventory_plan", "model_comparison", "sales_outliers", "executive_summary"):
        assert any((tmp_path / "out" / name).iterdir())
    sales, stores = load_raw_data(spark, sf_small)
    out = run_pipeline(sales, stores, PipelineConfig(models=("naive",)))
    written = write_outputs({k: v for k, v in out.items() if k in ("inventory_plan", "models")}, str(tmp_path / "two"))
    assert len(written) == 1 and isinstance(out["inventory_plan"], DataFrame)
