"""Registered queries: one per operator, each built from the whole driver
tables of a scale-factor folder.

Every query ends in a projection that rounds floating columns (sums of
cents to 2 digits, means and trigonometry to 6) so that results can be
compared with another engine whose float summation order differs. The
operators themselves keep the rounding they are defined with.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LINEAR_FEATURES, MAPE_EPS, STUMP_FEATURES, STUMPS, TREE_FEATURES, InventoryParams
from ..operators import chartdata as charts
from ..operators import evaluation as ev
from ..operators import features as fe
from ..operators import inventory as inv
from ..operators import ml
from ..operators import profiles as pr
from ..operators import split as sp
from ..operators.baselines import MovingAverageForecaster, NaiveForecaster, naive_last
from ..operators.boosting import LeafTreesForecaster
from ..operators.clean import build_store_weekly, clean_sales, drop_incomplete, enrich_stores, enrich_stores_skewed
from ..session import fresh_path, materialize
from ..sources import tables
from ..sources.sinks import write_table
from .pipeline import (
    BASELINE_MODELS,
    PipelineConfig,
    model_columns,
    run_pipeline,
    score_holdout,
    with_best_prediction,
)
from .report import executive_summary, report_lines

CAL_COLS = ["year", "month", "week_of_year", "quarter", "is_month_end", "trend"]
TRIG_COLS = ["week_sin", "week_cos", "month_sin", "month_cos"]
LAG_COLS = ["sales_lag_1", "sales_lag_2", "sales_lag_4", "sales_lag_12"]
ROLL_COLS = ["sales_roll_4", "sales_roll_12"]
NAIVE_COL = "pred_Naive_Last_Value"
MA_COL = "pred_Moving_Average_4w"


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named columns, keep the others (order preserved)."""
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def feature_rounding() -> dict[str, int]:
    d = {c: 6 for c in TRIG_COLS + ROLL_COLS + ["size_norm"]}
    d.update({c: 2 for c in LAG_COLS + ["Weekly_Sales"]})
    return d


class Ctx:
    """Building blocks of one query; nothing is shared between queries."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def sales(self) -> DataFrame:
        return tables.load_sales(self.spark, self.sf_dir)

    @cached_property
    def stores(self) -> DataFrame:
        return tables.load_stores(self.spark, self.sf_dir)

    @cached_property
    def store_weekly(self) -> DataFrame:
        return build_store_weekly(self.sales, self.stores)

    @cached_property
    def store_weekly_m(self) -> DataFrame:
        """The store-week table written once to the shared checkpoint folder,
        so queries that read it more than once scan the raw tables once."""
        return materialize(self.store_weekly)

    @cached_property
    def features(self) -> DataFrame:
        """Written once to the shared checkpoint folder: the queries below
        read it several times (cutoff, train, holdout, models)."""
        return materialize(fe.prepare_features(self.store_weekly_m))

    @cached_property
    def cutoff_row(self):
        return sp.cutoff_info(self.store_weekly_m).first()  # one row

    @cached_property
    def cutoff(self) -> DataFrame:
        return self.spark.createDataFrame([self.cutoff_row], "cutoff_date date, last_train_date date")

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return sp.train_holdout_split(self.features, cutoff=self.cutoff_row["cutoff_date"])

    @property
    def train(self) -> DataFrame:
        return self.split[0]

    @property
    def holdout(self) -> DataFrame:
        return self.split[1]

    @cached_property
    def baseline_models(self) -> list:
        return [NaiveForecaster().fit(self.train), MovingAverageForecaster(4).fit(self.train)]

    @cached_property
    def scored(self) -> DataFrame:
        return materialize(score_holdout(self.holdout, self.baseline_models))

    @cached_property
    def metrics(self) -> DataFrame:
        return ev.evaluate_models(self.scored, model_columns(self.baseline_models))

    @cached_property
    def ranked(self) -> DataFrame:
        return materialize(ev.compare_models(self.metrics))

    @cached_property
    def forecasts(self) -> DataFrame:
        return with_best_prediction(self.scored, self.ranked, self.baseline_models)

    @cached_property
    def stats(self) -> DataFrame:
        return inv.compute_demand_stats(self.train)

    @cached_property
    def plan(self) -> DataFrame:
        return inv.build_inventory_plan(self.stats, self.forecasts, InventoryParams())

    @cached_property
    def ridge(self):
        return ml.RidgeForecaster().fit(self.train)

    @cached_property
    def trees(self):
        return LeafTreesForecaster().fit(self.train)

    def scored_with(self, models: list) -> DataFrame:
        return materialize(score_holdout(self.holdout, models), "scored")

    @cached_property
    def ridge_models(self) -> list:
        """The models that SQL can express: the baselines and ridge."""
        return [*self.baseline_models, self.ridge]

    @cached_property
    def scored_ridge(self) -> DataFrame:
        return self.scored_with(self.ridge_models)

    @cached_property
    def all_models(self) -> list:
        return [*self.ridge_models, self.trees]

    @cached_property
    def scored_all(self) -> DataFrame:
        return self.scored_with(self.all_models)


PLAN_ROUNDING = {"avg_weekly_demand": 6, "std_weekly_demand": 6, "forecast_avg_demand": 6, "demand_used": 6}
FORECAST_ROUNDING = {"Weekly_Sales": 2, "actual": 2, NAIVE_COL: 2, MA_COL: 6, "predicted": 6}


def _q(fn: Callable[[Ctx], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Ctx(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---------------------------------------------------------------------------
# Sources and sinks
# ---------------------------------------------------------------------------

def scan_sales(c: Ctx) -> DataFrame:
    return rounded(c.sales, {"Weekly_Sales": 2})


def scan_stores(c: Ctx) -> DataFrame:
    return c.stores


def write_table_roundtrip(c: Ctx) -> DataFrame:
    """Store-week table written as parquet to the shared folder and read back."""
    path = fresh_path(c.spark, "store_weekly")
    write_table(c.store_weekly, path)
    return rounded(c.spark.read.parquet(path), {"Weekly_Sales": 2})


def csv_roundtrip(c: Ctx) -> DataFrame:
    """Sales and stores written as CSV files, found again through the
    folder-then-parent fallback, and aggregated to store-weeks. The sales
    file has a department column and another column order."""
    base = fresh_path(c.spark, "csv")
    wide = c.sales.select("Date", "Store", (F.col("Store") % 99).alias("Dept"), "IsHoliday", "Weekly_Sales")
    write_table(wide, f"{base}/train.csv", fmt="csv")
    write_table(c.stores, f"{base}/stores.csv", fmt="csv")
    sales, stores = tables.load_raw_csv(c.spark, f"{base}/data")  # falls back to ``base``
    return rounded(build_store_weekly(sales, stores), {"Weekly_Sales": 2})


# ---------------------------------------------------------------------------
# Profiles
# ---------------------------------------------------------------------------

def dataset_profile(c: Ctx) -> DataFrame:
    return pr.dataset_profile(c.store_weekly)


def raw_profile(c: Ctx) -> DataFrame:
    return pr.raw_profile(c.sales, c.stores)


def negative_sales_profile(c: Ctx) -> DataFrame:
    return pr.negative_sales_profile(c.sales)


def split_profile(c: Ctx) -> DataFrame:
    return pr.split_profile(c.train, c.holdout, c.cutoff)


# ---------------------------------------------------------------------------
# Filters, joins, aggregation
# ---------------------------------------------------------------------------

def clean_sales_q(c: Ctx) -> DataFrame:
    return rounded(clean_sales(c.sales), {"Weekly_Sales": 2})


def enrich_stores_q(c: Ctx) -> DataFrame:
    return rounded(enrich_stores(c.sales, c.stores), {"Weekly_Sales": 2})


def enrich_stores_skewed_q(c: Ctx) -> DataFrame:
    """The store join with stores that hold half a task's rows apart."""
    return rounded(enrich_stores_skewed(c.sales, c.stores), {"Weekly_Sales": 2})


def store_weekly(c: Ctx) -> DataFrame:
    return rounded(c.store_weekly, {"Weekly_Sales": 2})


def drop_incomplete_q(c: Ctx) -> DataFrame:
    return rounded(drop_incomplete(fe.prepare_features(c.store_weekly_m)), feature_rounding())


def train_rows(c: Ctx) -> DataFrame:
    cut = F.lit(c.cutoff_row["cutoff_date"])
    return rounded(sp.train_rows(c.features, cut).select("Store", "Date", "Weekly_Sales"), {"Weekly_Sales": 2})


def holdout_rows(c: Ctx) -> DataFrame:
    cut = F.lit(c.cutoff_row["cutoff_date"])
    return rounded(sp.holdout_rows(c.features, cut).select("Store", "Date", "Weekly_Sales"), {"Weekly_Sales": 2})


def type_code_lookup(c: Ctx) -> DataFrame:
    return c.store_weekly.select("Type").distinct().withColumn("type_code", fe.type_code("Type"))


def first_date(c: Ctx) -> DataFrame:
    return fe.first_date(c.store_weekly)


def size_moments(c: Ctx) -> DataFrame:
    return rounded(fe.size_moments(c.store_weekly), {"size_mean": 6, "size_std": 6})


# ---------------------------------------------------------------------------
# Features and split
# ---------------------------------------------------------------------------

def time_features(c: Ctx) -> DataFrame:
    df = fe.add_time_features(c.store_weekly_m)
    return rounded(df.select("Store", "Date", *CAL_COLS, *TRIG_COLS), {k: 6 for k in TRIG_COLS})


def store_features(c: Ctx) -> DataFrame:
    df = fe.add_store_features(c.store_weekly_m)
    return rounded(df.select("Store", "Date", "Type", "type_code", "size_norm"), {"size_norm": 6})


def lag_features(c: Ctx) -> DataFrame:
    df = fe.add_lag_features(c.store_weekly, windows=())
    return rounded(df.select("Store", "Date", *LAG_COLS), {k: 2 for k in LAG_COLS})


def rolling_features(c: Ctx) -> DataFrame:
    df = fe.add_lag_features(c.store_weekly, lags=())
    return rounded(df.select("Store", "Date", *ROLL_COLS), {k: 6 for k in ROLL_COLS})


def prepare_features(c: Ctx) -> DataFrame:
    return rounded(fe.prepare_features(c.store_weekly_m), feature_rounding())


def cutoff_date(c: Ctx) -> DataFrame:
    return sp.cutoff_info(c.store_weekly)


def train_holdout_split(c: Ctx) -> DataFrame:
    t = c.train.select("Store", "Date", "Weekly_Sales", F.lit("train").alias("split"))
    h = c.holdout.select("Store", "Date", "Weekly_Sales", F.lit("holdout").alias("split"))
    return rounded(t.unionByName(h), {"Weekly_Sales": 2})


def validation_tail(c: Ctx) -> DataFrame:
    return sp.validation_flag(c.train, mode="chronological").select("Store", "Date", "is_validation")


def validation_tail_rows(c: Ctx) -> DataFrame:
    return sp.validation_flag(c.train, mode="tail_rows").select("Store", "Date", "is_validation")


# ---------------------------------------------------------------------------
# Baseline forecasts and metrics
# ---------------------------------------------------------------------------

def naive_last_q(c: Ctx) -> DataFrame:
    return rounded(naive_last(c.train), {"last_value": 2})


def forecast_naive(c: Ctx) -> DataFrame:
    m = c.baseline_models[0]
    return rounded(m.predict(c.holdout).select("Store", "Date", m.output_col), {m.output_col: 2})


def forecast_moving_average(c: Ctx) -> DataFrame:
    m = c.baseline_models[1]
    return rounded(m.predict(c.holdout).select("Store", "Date", m.output_col), {m.output_col: 6})


def forecast_table(c: Ctx) -> DataFrame:
    return rounded(c.forecasts, FORECAST_ROUNDING)


def _single_metric(c: Ctx, name: str, expr_fn) -> DataFrame:
    long = ev.long_predictions(c.scored, model_columns(c.baseline_models))
    return long.groupBy("Model").agg(F.round(expr_fn("actual", "predicted"), 6).alias(name))


def mae(c: Ctx) -> DataFrame:
    from ..functions import metrics as M
    return _single_metric(c, "MAE", M.mae)


def rmse(c: Ctx) -> DataFrame:
    from ..functions import metrics as M
    return _single_metric(c, "RMSE", M.rmse)


def mape(c: Ctx) -> DataFrame:
    from ..functions import metrics as M
    return _single_metric(c, "MAPE", M.mape)


def r2(c: Ctx) -> DataFrame:
    from ..functions import metrics as M
    return _single_metric(c, "R2", M.r2)


def nonzero_actuals(c: Ctx) -> DataFrame:
    a = F.col("actual")
    return c.scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(a) > F.lit(MAPE_EPS)).alias("n_nonzero"))


def evaluate_models(c: Ctx) -> DataFrame:
    return c.metrics


def rank_models(c: Ctx) -> DataFrame:
    return ev.rank_models(c.metrics).select("Model", "RMSE", "Rank")


def rmse_vs_worst(c: Ctx) -> DataFrame:
    return ev.rmse_vs_worst(c.metrics).select("Model", "RMSE", ev.VS_WORST_COL)


def model_comparison(c: Ctx) -> DataFrame:
    return c.ranked


def best_model(c: Ctx) -> DataFrame:
    return ev.best_model(c.ranked)


# ---------------------------------------------------------------------------
# Inventory
# ---------------------------------------------------------------------------

def demand_stats(c: Ctx) -> DataFrame:
    return rounded(c.stats, {"avg_weekly_demand": 6, "std_weekly_demand": 6})


def mean_forecast_by_store(c: Ctx) -> DataFrame:
    return rounded(inv.mean_forecast_by_store(c.forecasts), {"forecast_avg_demand": 6})


def attach_forecast(c: Ctx) -> DataFrame:
    fwd = inv.mean_forecast_by_store(c.forecasts)
    df = c.stats.join(fwd, "Store", "left").select("Store", "avg_weekly_demand", "forecast_avg_demand")
    return rounded(df, {"avg_weekly_demand": 6, "forecast_avg_demand": 6})


def inventory_plan_history(c: Ctx) -> DataFrame:
    return rounded(inv.build_inventory_plan(c.stats, None), PLAN_ROUNDING)


def inventory_plan(c: Ctx) -> DataFrame:
    return rounded(c.plan, PLAN_ROUNDING)


def replenishment_alerts(c: Ctx) -> DataFrame:
    return rounded(inv.replenishment_alerts(c.plan), {"demand_used": 6})


def plan_summary(c: Ctx) -> DataFrame:
    s = inv.summarise_inventory(c.plan)
    return rounded(s, {"avg_safety_stock": 4, "avg_reorder_point": 4, "avg_eoq": 4})


# ---------------------------------------------------------------------------
# Chart data
# ---------------------------------------------------------------------------

def first_store_per_type(c: Ctx) -> DataFrame:
    return charts.first_store_per_type(c.store_weekly)


def store_subset(c: Ctx) -> DataFrame:
    sw = c.store_weekly_m
    ids = charts.first_store_per_type(sw).select("Store")
    return rounded(charts.store_subset(sw, ids), {"Weekly_Sales": 2})


def holiday_dates(c: Ctx) -> DataFrame:
    return charts.holiday_bands(c.store_weekly_m)


def demand_trend_data(c: Ctx) -> DataFrame:
    return rounded(charts.demand_trend_data(c.store_weekly_m), {"sales_musd": 8})


def actual_by_date(c: Ctx) -> DataFrame:
    return rounded(charts.actual_by_date(c.holdout), {"actual_total": 2})


def predicted_by_date(c: Ctx) -> DataFrame:
    return rounded(charts.predicted_by_date(c.scored, [NAIVE_COL, MA_COL]), {NAIVE_COL: 2, MA_COL: 4})


def actual_vs_predicted_data(c: Ctx) -> DataFrame:
    df = charts.actual_vs_predicted_data(c.scored, [NAIVE_COL, MA_COL])
    # Moving-average values lie on a 1/1200-dollar grid: 11 digits in $M
    # (1e-5 dollars) can never fall on a rounding tie for them.
    return rounded(df, {"actual_musd": 11, NAIVE_COL: 11, MA_COL: 11})


def model_comparison_data(c: Ctx) -> DataFrame:
    return charts.model_comparison_data(c.ranked)


def plan_head(c: Ctx) -> DataFrame:
    return rounded(charts.plan_head(c.plan), PLAN_ROUNDING)


def inventory_scatter_data(c: Ctx) -> DataFrame:
    df = charts.inventory_scatter_data(c.plan)
    return rounded(df, {"avg_demand_musd": 9, "reorder_point_musd": 8, "bubble_size": 6})


def residual_data(c: Ctx) -> DataFrame:
    return rounded(charts.residual_data(c.forecasts), {"predicted_musd": 11, "residual_musd": 11})


def residual_histogram(c: Ctx) -> DataFrame:
    h = charts.residual_histogram(charts.residual_data(c.forecasts))
    return rounded(h, {"bin_lo": 6, "bin_hi": 6})


BOX_ROUNDING = {k: 8 for k in ("q1", "median", "q3", "whisker_lo", "whisker_hi")}


def sales_distribution_by_type(c: Ctx) -> DataFrame:
    return rounded(charts.sales_distribution_by_type(c.store_weekly_m), BOX_ROUNDING)


def sales_outliers_by_type(c: Ctx) -> DataFrame:
    return rounded(charts.sales_outliers_by_type(c.store_weekly_m), {"sales_musd": 8})


# ---------------------------------------------------------------------------
# Spark ML forecasters
# ---------------------------------------------------------------------------

def select_linear_features(c: Ctx) -> DataFrame:
    df = ml.select_linear_features(c.holdout, keep=["Store", "Date"])
    return rounded(df, {k: 6 for k in LINEAR_FEATURES})


def select_tree_features(c: Ctx) -> DataFrame:
    df = ml.select_tree_features(c.holdout, keep=["Store", "Date"])
    return rounded(df, {k: 6 for k in TREE_FEATURES})


def standard_scaler(c: Ctx) -> DataFrame:
    df = ml.standard_scale(c.train, c.holdout, keep=["Store", "Date"])
    return rounded(df, {k: 6 for k in LINEAR_FEATURES})


def forecast_ridge(c: Ctx) -> DataFrame:
    m = c.ridge
    return rounded(m.predict(c.holdout).select("Store", "Date", m.output_col), {m.output_col: 2})


def evaluate_models_ridge(c: Ctx) -> DataFrame:
    """Baselines and ridge, the models that SQL can check."""
    return ev.evaluate_models(c.scored_ridge, model_columns(c.ridge_models))


def model_comparison_ridge(c: Ctx) -> DataFrame:
    return ev.compare_models(evaluate_models_ridge(c))


def evaluate_models_all(c: Ctx) -> DataFrame:
    """All four models."""
    return ev.evaluate_models(c.scored_all, model_columns(c.all_models))


def model_comparison_all(c: Ctx) -> DataFrame:
    return ev.compare_models(evaluate_models_all(c))


def forecast_table_all(c: Ctx) -> DataFrame:
    ranked = materialize(model_comparison_all(c), "ranked")
    return with_best_prediction(c.scored_all, ranked, c.all_models)


def actual_vs_predicted_all(c: Ctx) -> DataFrame:
    return charts.actual_vs_predicted_data(c.scored_all, list(model_columns(c.all_models).values()))


def forecast_gbt(c: Ctx) -> DataFrame:
    m = c.trees
    return m.predict(c.holdout).select("Store", "Date", m.output_col)


def forecast_stumps(c: Ctx) -> DataFrame:
    """A few trees of one split each on features of few values: the learner
    of ``forecast_gbt`` where SQL can follow it."""
    m = LeafTreesForecaster(STUMPS, STUMP_FEATURES).fit(c.train)
    return rounded(m.predict(c.holdout).select("Store", "Date", m.output_col), {m.output_col: 2})


def stump_table(c: Ctx) -> DataFrame:
    """The node table of those trees."""
    m = LeafTreesForecaster(STUMPS, STUMP_FEATURES).fit(c.train)
    return rounded(m.node_table(c.spark).select("tree", "node", "left", "right", "feature", "threshold", "n_rows", "value"), {"value": 3})


def feature_importance(c: Ctx) -> DataFrame:
    return c.trees.feature_importances_df(c.spark)


def top_features(c: Ctx) -> DataFrame:
    return charts.top_features(c.trees.feature_importances_df(c.spark))


# ---------------------------------------------------------------------------
# Whole runs
# ---------------------------------------------------------------------------

def executive_summary_q(c: Ctx) -> DataFrame:
    s = executive_summary(c.store_weekly_m, c.ranked, c.plan, 12)
    return rounded(s, {"avg_safety_stock": 4, "avg_reorder_point": 4, "avg_eoq": 4})


def report_text(c: Ctx) -> DataFrame:
    p = InventoryParams()
    return report_lines(executive_summary(c.store_weekly_m, c.ranked, c.plan, 12), c.ranked, p.lead_time_weeks, p.service_level)


def plan_summary_text(c: Ctx) -> DataFrame:
    return inv.inventory_summary_text(inv.summarise_inventory(c.plan))


def demand_pipeline(c: Ctx) -> DataFrame:
    """All four models; the plan driven by the best one."""
    return rounded(run_pipeline(c.sales, c.stores)["inventory_plan"], PLAN_ROUNDING)


def pipeline_baselines(c: Ctx) -> DataFrame:
    """The pipeline with the two baselines only (fully checkable in SQL)."""
    out = run_pipeline(c.sales, c.stores, PipelineConfig(models=BASELINE_MODELS))
    return rounded(out["inventory_plan"], PLAN_ROUNDING)


_REGISTRY: dict[str, Callable[[Ctx], DataFrame]] = {
    "scan_sales": scan_sales,
    "scan_stores": scan_stores,
    "write_table": write_table_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "dataset_profile": dataset_profile,
    "raw_profile": raw_profile,
    "negative_sales_profile": negative_sales_profile,
    "split_profile": split_profile,
    "clean_sales": clean_sales_q,
    "drop_incomplete": drop_incomplete_q,
    "train_rows": train_rows,
    "holdout_rows": holdout_rows,
    "enrich_stores": enrich_stores_q,
    "enrich_stores_skewed": enrich_stores_skewed_q,
    "type_code_lookup": type_code_lookup,
    "store_weekly": store_weekly,
    "first_date": first_date,
    "size_moments": size_moments,
    "time_features": time_features,
    "store_features": store_features,
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "prepare_features": prepare_features,
    "cutoff_date": cutoff_date,
    "train_holdout_split": train_holdout_split,
    "validation_tail": validation_tail,
    "validation_tail_rows": validation_tail_rows,
    "naive_last": naive_last_q,
    "naive_lookup": forecast_naive,
    "forecast_naive": forecast_naive,
    "forecast_moving_average": forecast_moving_average,
    "forecast_table": forecast_table,
    "mae": mae,
    "rmse": rmse,
    "mape": mape,
    "r2": r2,
    "nonzero_actuals": nonzero_actuals,
    "evaluate_models": evaluate_models,
    "rank_models": rank_models,
    "rmse_vs_worst": rmse_vs_worst,
    "model_comparison": model_comparison,
    "best_model": best_model,
    "demand_stats": demand_stats,
    "mean_forecast_by_store": mean_forecast_by_store,
    "attach_forecast": attach_forecast,
    "inventory_plan_history": inventory_plan_history,
    "inventory_plan": inventory_plan,
    "replenishment_alerts": replenishment_alerts,
    "plan_summary": plan_summary,
    "first_store_per_type": first_store_per_type,
    "store_subset": store_subset,
    "holiday_dates": holiday_dates,
    "demand_trend_data": demand_trend_data,
    "actual_by_date": actual_by_date,
    "predicted_by_date": predicted_by_date,
    "actual_vs_predicted_data": actual_vs_predicted_data,
    "model_comparison_data": model_comparison_data,
    "plan_head": plan_head,
    "inventory_scatter_data": inventory_scatter_data,
    "residual_data": residual_data,
    "residual_histogram": residual_histogram,
    "sales_distribution_by_type": sales_distribution_by_type,
    "sales_outliers_by_type": sales_outliers_by_type,
    "select_linear_features": select_linear_features,
    "select_tree_features": select_tree_features,
    "standard_scaler": standard_scaler,
    "forecast_ridge": forecast_ridge,
    "evaluate_models_ridge": evaluate_models_ridge,
    "model_comparison_ridge": model_comparison_ridge,
    "forecast_gbt": forecast_gbt,
    "forecast_stumps": forecast_stumps,
    "stump_table": stump_table,
    "evaluate_models_all": evaluate_models_all,
    "model_comparison_all": model_comparison_all,
    "forecast_table_all": forecast_table_all,
    "actual_vs_predicted_all": actual_vs_predicted_all,
    "feature_importance": feature_importance,
    "top_features": top_features,
    "executive_summary": executive_summary_q,
    "report_text": report_text,
    "plan_summary_text": plan_summary_text,
    "pipeline_baselines": pipeline_baselines,
    "demand_pipeline": demand_pipeline,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _q(fn) for name, fn in _REGISTRY.items()}
