"""Scoring forecasts on the holdout and ranking the models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import MAPE_EPS
from ..functions import metrics as M

METRIC_DIGITS = {"MAE": 2, "RMSE": 2, "MAPE": 2, "R2": 4}
VS_WORST_COL = "RMSE_vs_Naive (%)"


def long_predictions(df: DataFrame, models: Mapping[str, str], actual_col: str = "actual",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide ``pred_*`` columns to rows (Model, actual, predicted); a narrow Generate."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("Model"), F.col(col).cast("double").alias("predicted"))
        for name, col in models.items()
    ])
    return df.select(*keep, F.col(actual_col).cast("double").alias("actual"), F.inline(pairs))


def evaluate_long(df: DataFrame, model_col: str = "Model", actual_col: str = "actual",
                  pred_col: str = "predicted", digits: Mapping[str, int] | None = METRIC_DIGITS,
                  eps: float = MAPE_EPS) -> DataFrame:
    """MAE, RMSE, MAPE and R2 per model over (model, actual, predicted) rows."""
    exprs = {
        "MAE": M.mae(actual_col, pred_col),
        "RMSE": M.rmse(actual_col, pred_col),
        "MAPE": M.mape(actual_col, pred_col, eps),
        "R2": M.r2(actual_col, pred_col),
    }
    if digits:
        exprs = {k: F.round(v, digits[k]) for k, v in exprs.items()}
    return df.groupBy(model_col).agg(*[v.alias(k) for k, v in exprs.items()])


def evaluate_models(forecasts: DataFrame, models: Mapping[str, str], actual_col: str = "actual",
                    digits: Mapping[str, int] | None = METRIC_DIGITS) -> DataFrame:
    """All models in one pass: unpivot, then one grouped aggregate."""
    return evaluate_long(long_predictions(forecasts, models, actual_col), digits=digits)


def rank_models(metrics: DataFrame) -> DataFrame:
    """Rank 1..n by RMSE (ties broken by name). The metrics table has one
    row per model, so the unpartitioned window is tiny by construction."""
    w = Window.orderBy(F.col("RMSE").asc_nulls_last(), F.col("Model"))
    return metrics.withColumn("Rank", F.row_number().over(w))


def rmse_vs_worst(metrics: DataFrame) -> DataFrame:
    """Percent RMSE reduction against the worst (highest-RMSE) model.

    The column keeps the name it is known by although it compares with the
    worst model, not specifically the naive one.
    """
    worst = F.max("RMSE").over(Window.partitionBy())
    return metrics.withColumn(VS_WORST_COL, F.round(F.try_divide(worst - F.col("RMSE"), worst) * 100, 1))


def rmse_vs_baseline(metrics: DataFrame, baseline: str) -> DataFrame:
    """Percent RMSE reduction against the named model (NULL if it is absent)."""
    own = F.max(F.when(F.col("Model") == baseline, F.col("RMSE"))).over(Window.partitionBy())
    return metrics.withColumn("rmse_vs_baseline_pct", F.round(F.try_divide(own - F.col("RMSE"), own) * 100, 1))


def compare_models(metrics: DataFrame) -> DataFrame:
    return rmse_vs_worst(rank_models(metrics))


def best_model(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy("Rank").limit(1)
