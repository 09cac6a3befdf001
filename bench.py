"""Benchmark: headline queries on one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with a ``noop`` write (no rows reach the
driver). ``value`` is the wall time of the whole pipeline -- load, clean,
aggregate, features, split, four models (trees of up to 500 rounds),
metrics, plan and every chart table -- the figure the original publishes
as "full pipeline run time". Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "store_weekly",
    "prepare_features",
    "train_holdout_split",
    "validation_tail",
    "model_comparison",
    "inventory_plan",
    "actual_vs_predicted_data",
    "residual_histogram",
    "sales_distribution_by_type",
    "forecast_ridge",
    "forecast_gbt",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from pyspark.sql import DataFrame

    from demand_engine.config import LeafTreeParams
    from demand_engine.plans.catalog import queries
    from demand_engine.plans.pipeline import run_pipeline
    from demand_engine.session import get_spark
    from demand_engine.sources import load_raw_data

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": "16g"})
    qs = queries()
    run(qs["dataset_profile"](spark, sf_dir))  # JVM warm-up, not timed

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(qs[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    sales, stores = load_raw_data(spark, sf_dir)
    out = run_pipeline(sales, stores)
    for df in out.values():
        if isinstance(df, DataFrame):
            run(df)
    pipeline_sec = round(time.perf_counter() - t0, 3)
    times["pipeline"] = pipeline_sec

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "full_pipeline_sec",
        "value": pipeline_sec,
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
        "spark": spark.version,
        "tree_rounds": LeafTreeParams().n_estimators,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
