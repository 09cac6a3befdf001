"""Executive summary: the figures as one row, and as report text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.formatting import money, percent
from ..operators.evaluation import VS_WORST_COL
from ..operators.inventory import summarise_inventory
from ..operators.profiles import dataset_profile


def executive_summary(store_weekly: DataFrame, ranked: DataFrame, plan: DataFrame, holdout_weeks: int) -> DataFrame:
    """One row: period, stores, holdout, best model and its gain, plan means."""
    prof = dataset_profile(store_weekly).select("first_date", "last_date", "n_stores")
    best = ranked.filter(F.col("Rank") == 1).select(
        F.col("Model").alias("best_model"), F.col(VS_WORST_COL).alias("rmse_gain_pct"))
    inv = summarise_inventory(plan).select("avg_safety_stock", "avg_reorder_point", "avg_eoq", "n_alerts")
    # Three one-row frames.
    return prof.crossJoin(best).crossJoin(inv).withColumn("holdout_weeks", F.lit(int(holdout_weeks)))


def report_lines(summary: DataFrame, ranked: DataFrame, lead_time_weeks: float, service_level: float) -> DataFrame:
    """(line_no, value) rows of the text report. Inputs are one row per model
    plus one summary row, so this is small by construction."""
    head = summary.select(F.posexplode(F.array(
        F.format_string("Sales of %d stores from %s to %s", F.col("n_stores"), F.col("first_date").cast("string"), F.col("last_date").cast("string")),
        F.format_string("Forecasts are held against the last %d weeks", "holdout_weeks"),
    )).alias("line_no", "value"))
    models = ranked.select(
        (F.lit(100) + F.col("Rank")).alias("line_no"),
        F.concat(F.format_string("%d. %s: mean error ", "Rank", "Model"), money("MAE"), F.lit(", root mean square "), money("RMSE"),
                 F.lit(", relative "), percent("MAPE", 2)).alias("value"))
    tail = summary.select(F.posexplode(F.array(
        F.concat(F.format_string("%s has the least error, ", "best_model"), percent("rmse_gain_pct"), F.lit(" under the worst")),
        F.lit(f"Stock for {lead_time_weeks:g} weeks of delivery at a service level of {service_level:.0%}"),
        F.concat(F.lit("Safety stock "), money("avg_safety_stock"), F.lit(", reorder point "), money("avg_reorder_point"),
                 F.lit(", economic order "), money("avg_eoq"), F.lit(" (means)")),
        F.format_string("%d stores should order early", "n_alerts"),
    )).alias("line_no", "value")).withColumn("line_no", F.col("line_no") + 1000)
    return head.unionByName(models).unionByName(tail)
