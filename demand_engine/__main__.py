"""Run the whole pipeline and write its outputs.

    python -m demand_engine --sf-dir /root/testdata/sf0.01 --out /path/to/outputs
    python -m demand_engine --csv-dir /path/to/data --out /path/to/outputs --format csv

Writes every output table (parquet or CSV folders) and the executive
summary as text under ``--out``. The output folder must be shared storage
on a cluster.
"""

from __future__ import annotations

import argparse
import time

from .config import HOLDOUT_WEEKS, SERVICE_LEVEL, InventoryParams, LeafTreeParams
from .plans.pipeline import ALL_MODELS, PipelineConfig, run_pipeline, write_outputs
from .plans.report import executive_summary, report_lines
from .session import get_spark, table_scope
from .sources import load_raw_csv, load_raw_data, write_text


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="demand_engine")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder with the driver parquet tables (lineitem, supplier)")
    src.add_argument("--csv-dir", help="folder (or child of the folder) holding train.csv and stores.csv")
    ap.add_argument("--out", required=True, help="output folder")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    ap.add_argument("--holdout-weeks", type=int, default=HOLDOUT_WEEKS)
    ap.add_argument("--tree-rounds", type=int, default=LeafTreeParams().n_estimators)
    ap.add_argument("--service-level", type=float, default=SERVICE_LEVEL)
    ap.add_argument("--models", default=",".join(ALL_MODELS))
    args = ap.parse_args(argv)

    spark = get_spark(args.master)
    t0 = time.time()
    sales, stores = load_raw_data(spark, args.sf_dir) if args.sf_dir else load_raw_csv(spark, args.csv_dir)
    cfg = PipelineConfig(holdout_weeks=args.holdout_weeks, trees=LeafTreeParams(n_estimators=args.tree_rounds),
                         inventory=InventoryParams(service_level=args.service_level),
                         models=tuple(m for m in args.models.split(",") if m))
    with table_scope(spark):  # shared tables go once the outputs are written
        out = run_pipeline(sales, stores, cfg)
        out.pop("models")
        write_outputs(out, args.out, fmt=args.format)
        summary = executive_summary(out["store_weekly"], out["model_comparison"], out["inventory_plan"], cfg.holdout_weeks)
        lines = report_lines(summary, out["model_comparison"], cfg.inventory.lead_time_weeks, cfg.inventory.service_level)
        write_text(lines.orderBy("line_no").select("value"), f"{args.out.rstrip('/')}/executive_summary")
        for row in lines.orderBy("line_no").collect():  # a few dozen report lines
            print(row["value"])
    print(f"Pipeline completed in {time.time() - t0:.1f}s.")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
