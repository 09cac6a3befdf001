"""The whole run as one function returning lazy DataFrames.

Actions happen only where they must: model fitting, and the shared tables
(Parquet in the shared folder) that cut the lineage back to the raw scan.
Everything downstream reads those.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HOLDOUT_WEEKS, LAGS, MOVING_AVERAGE_WINDOW, RIDGE_ALPHA, ROLLING_WINDOWS, InventoryParams, LeafTreeParams, TreeParams
from ..operators import chartdata as charts
from ..operators.baselines import MovingAverageForecaster, NaiveForecaster
from ..operators.boosting import LeafTreesForecaster
from ..operators.clean import build_store_weekly, duplicated_stores
from ..operators.common import attach_scalars
from ..operators.evaluation import compare_models, evaluate_models
from ..operators.features import prepare_features
from ..operators.inventory import build_inventory_plan, compute_demand_stats, replenishment_alerts, summarise_inventory
from ..operators.ml import BoostedTreesForecaster, RidgeForecaster
from ..operators.profiles import dataset_profile, split_profile
from ..operators.split import cutoff_info, train_holdout_split
from ..session import materialize

ALL_MODELS = ("naive", "moving_average", "ridge", "trees")
BASELINE_MODELS = ("naive", "moving_average")


@dataclass(frozen=True)
class PipelineConfig:
    holdout_weeks: int = HOLDOUT_WEEKS
    ma_window: int = MOVING_AVERAGE_WINDOW
    ridge_alpha: float = RIDGE_ALPHA
    trees: LeafTreeParams | TreeParams = field(default_factory=LeafTreeParams)  # by leaf, or by level
    inventory: InventoryParams = field(default_factory=InventoryParams)
    models: Sequence[str] = ALL_MODELS
    target: str = "Weekly_Sales"
    lags: Sequence[int] = LAGS
    windows: Sequence[int] = ROLLING_WINDOWS
    fit_on: str = "all"  # or "train": rows that give the size moments
    unique_stores: bool = False


def make_forecasters(cfg: PipelineConfig) -> list:
    makers = {
        "naive": lambda: NaiveForecaster(target=cfg.target),
        "moving_average": lambda: MovingAverageForecaster(cfg.ma_window),
        "ridge": lambda: RidgeForecaster(cfg.ridge_alpha, target=cfg.target),
        "trees": lambda: (BoostedTreesForecaster if isinstance(cfg.trees, TreeParams) else LeafTreesForecaster)(cfg.trees, target=cfg.target),
    }
    unknown = [m for m in cfg.models if m not in makers]
    if unknown:
        raise ValueError(f"unknown models {unknown}; choose from {list(makers)}")
    return [makers[m]() for m in cfg.models]


def fit_models(train: DataFrame, cfg: PipelineConfig) -> list:
    return [f.fit(train) for f in make_forecasters(cfg)]


def score_holdout(holdout: DataFrame, models: list, target: str = "Weekly_Sales") -> DataFrame:
    """Store, Date, target, actual and one ``pred_*`` column per model."""
    scored = holdout
    for m in models:
        scored = m.predict(scored)
    return scored.select("Store", "Date", target, F.col(target).alias("actual"), *[m.output_col for m in models])


def model_columns(models: list) -> dict[str, str]:
    return {m.name: m.output_col for m in models}


def with_best_prediction(scored: DataFrame, ranked: DataFrame, models: list) -> DataFrame:
    """``predicted`` = the column of the rank-1 model (attached as a one-row cross join)."""
    best = ranked.filter(F.col("Rank") == 1).select(F.col("Model").alias("_best"))
    pick = None
    for name, col in model_columns(models).items():
        cond = F.col("_best") == name
        pick = F.when(cond, F.col(col)) if pick is None else pick.when(cond, F.col(col))
    # ``best`` is one row (rank 1 of a one-row-per-model table).
    return attach_scalars(scored, best).withColumn("predicted", pick).drop("_best")


def run_pipeline(sales: DataFrame, stores: DataFrame, cfg: PipelineConfig | None = None,
                 checkpoint: bool = True) -> dict[str, DataFrame]:
    """Every output of a run, as DataFrames.

    With ``checkpoint`` (the default) the shared intermediate tables are
    written once as Parquet to the shared folder: the store-week and feature
    tables, the scored holdout, the ranked metrics and the plan. Each is
    read by several outputs, which then cost one pruned scan instead of
    re-running their whole lineage. The cutoff comes from the narrow
    store-week table, once, so the split filters are literals that are
    pushed into the feature scan.

    Raises where ``cfg.unique_stores`` and a store has several rows; warns
    where all sizes are equal (``size_norm`` is then missing everywhere).
    """
    cfg = cfg or PipelineConfig()
    keep = materialize if checkpoint else (lambda df: df)
    if cfg.unique_stores and (twice := duplicated_stores(stores).take(5)):
        raise ValueError(f"stores with several rows, e.g. {[r['Store'] for r in twice]}")
    store_weekly = keep(build_store_weekly(sales, stores, cfg.target))
    sizes = store_weekly.agg(F.min("Size").alias("lo"), F.max("Size").alias("hi")).first()
    if sizes["lo"] is not None and sizes["lo"] == sizes["hi"]:
        warnings.warn("all stores have one size: size_norm is missing and complete rows are empty", stacklevel=2)
    windows = sorted({*cfg.windows, cfg.ma_window})
    make = lambda fit_on=None: prepare_features(store_weekly, lags=cfg.lags, windows=windows, sales_col=cfg.target, fit_on=fit_on)
    cut = cutoff_info(store_weekly, cfg.holdout_weeks)
    if cfg.fit_on == "train":
        limit = cut.select("cutoff_date").scalar()
        features = keep(make(store_weekly.filter(F.col("Date") < limit)))
    else:
        features = keep(make())
    if checkpoint:
        row = cut.first()  # one row: the cutoff and the date before it
        cut = features.sparkSession.createDataFrame([row], cut.schema)
        train, holdout = train_holdout_split(features, cfg.holdout_weeks, cutoff=row["cutoff_date"])
    else:
        train, holdout = train_holdout_split(features, cfg.holdout_weeks)

    models = fit_models(train, cfg)
    scored = keep(score_holdout(holdout, models, cfg.target))
    ranked = keep(compare_models(evaluate_models(scored, model_columns(models))))
    forecasts = with_best_prediction(scored, ranked, models)

    box = keep(charts.sales_distribution_by_type(store_weekly, value_col=cfg.target))
    stats = compute_demand_stats(train, "Store", cfg.target)
    plan = keep(build_inventory_plan(stats, forecasts, cfg.inventory))
    out = {
        "store_weekly": store_weekly,
        "features": features,
        "dataset_profile": dataset_profile(store_weekly),
        "split_profile": split_profile(train, holdout, cut),
        "train": train,
        "holdout": holdout,
        "model_comparison": ranked,
        "forecasts": forecasts,
        "demand_stats": stats,
        "inventory_plan": plan,
        "replenishment_alerts": replenishment_alerts(plan),
        "inventory_summary": summarise_inventory(plan),
        "demand_trend": charts.demand_trend_data(store_weekly, value_col=cfg.target),
        "holiday_bands": charts.holiday_bands(store_weekly, value_col=cfg.target),
        "actual_vs_predicted": charts.actual_vs_predicted_data(forecasts, list(model_columns(models).values())),
        "model_comparison_chart": charts.model_comparison_data(ranked),
        "inventory_scatter": charts.inventory_scatter_data(plan),
        "sales_by_type": box,
        "sales_outliers": charts.sales_outliers_by_type(store_weekly, value_col=cfg.target, box=box),
        "residuals": charts.residual_data(forecasts),
    }
    out["residual_histogram"] = charts.residual_histogram(out["residuals"])
    trees = [m for m in models if hasattr(m, "feature_importances_df")]
    if trees:
        imp = trees[0].feature_importances_df(sales.sparkSession)
        out["feature_importance"] = imp
        out["top_features"] = charts.top_features(imp)
    out["models"] = models  # fitted model objects, for callers that want them
    return out


def write_outputs(results: dict, out_dir: str, fmt: str = "parquet") -> list[str]:
    """Write every DataFrame result under ``out_dir/<name>``."""
    from ..sources.sinks import write_table

    written = []
    for name, df in results.items():
        if isinstance(df, DataFrame):
            written.append(write_table(df, f"{out_dir.rstrip('/')}/{name}", fmt=fmt))
    return written
