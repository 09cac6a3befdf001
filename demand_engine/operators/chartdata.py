"""Chart-ready tables. Drawing is left to the consumer; these are the data
behind the demand-trend, actual-vs-predicted, model-comparison, feature
importance, inventory scatter, box-plot and residual charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import clip_lower, safe_div
from ..session import materialize
from .common import attach_scalars

MILLION = 1e6


def in_millions(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c) / F.lit(MILLION)


# ---------------------------------------------------------------------------
# Demand trend
# ---------------------------------------------------------------------------

def first_store_per_type(store_weekly: DataFrame, n_types: int = 3) -> DataFrame:
    """Lowest store id of each type, types in order, first ``n_types``."""
    return (
        store_weekly.filter(F.col("Store").isNotNull() & F.col("Type").isNotNull())
        .groupBy("Type").agg(F.min("Store").alias("Store"))
        .orderBy("Type").limit(n_types)
    )


def store_subset(df: DataFrame, store_ids: Sequence[int] | DataFrame, group_col: str = "Store") -> DataFrame:
    """Rows of the given stores (a list, or a DataFrame of ids via a semi join)."""
    if isinstance(store_ids, DataFrame):
        return df.join(store_ids.select(group_col), group_col, "left_semi")
    return df.filter(F.col(group_col).isin(list(store_ids)))


def holiday_dates(subset: DataFrame, band_days: int = 7) -> DataFrame:
    """Distinct holiday dates with the end of their shading band."""
    return (
        subset.filter(F.col("IsHoliday")).select("Date").distinct()
        .withColumn("band_end", F.date_add("Date", band_days))
    )


def demand_trend_data(store_weekly: DataFrame, store_ids: Sequence[int] | None = None, value_col: str = "Weekly_Sales") -> DataFrame:
    """Weekly sales in $M of a few stores (default: first store of each type)."""
    if store_ids is None:
        # At most ``n_types`` rows: a proven bound, so broadcasting is safe.
        ids = F.broadcast(first_store_per_type(store_weekly).select("Store"))
        subset = store_subset(store_weekly, ids)
    else:
        subset = store_subset(store_weekly, store_ids)
    return subset.select("Store", "Type", "Date", "IsHoliday", in_millions(value_col).alias("sales_musd"))


def holiday_bands(store_weekly: DataFrame, store_ids: Sequence[int] | None = None, value_col: str = "Weekly_Sales") -> DataFrame:
    return holiday_dates(demand_trend_data(store_weekly, store_ids, value_col))


# ---------------------------------------------------------------------------
# Actual vs predicted, residuals
# ---------------------------------------------------------------------------

def actual_by_date(holdout: DataFrame, actual_col: str = "Weekly_Sales") -> DataFrame:
    return holdout.groupBy("Date").agg(F.sum(actual_col).alias("actual_total"))


def predicted_by_date(forecasts: DataFrame, pred_cols: Sequence[str]) -> DataFrame:
    return forecasts.groupBy("Date").agg(*[F.sum(c).alias(c) for c in pred_cols])


def actual_vs_predicted_data(forecasts: DataFrame, pred_cols: Sequence[str], actual_col: str = "actual") -> DataFrame:
    """Per date: total actual and total prediction of every model, in $M (one pass)."""
    return forecasts.groupBy("Date").agg(
        in_millions(F.sum(actual_col)).alias("actual_musd"),
        *[in_millions(F.sum(c)).alias(c) for c in pred_cols],
    )


def residual_data(forecasts: DataFrame, pred_col: str = "predicted", actual_col: str = "actual",
                  keep: Sequence[str] = ("Store", "Date")) -> DataFrame:
    """Prediction and residual (actual - predicted) in $M, per row."""
    return forecasts.select(
        *keep,
        in_millions(pred_col).alias("predicted_musd"),
        in_millions(F.col(actual_col) - F.col(pred_col)).alias("residual_musd"),
    )


def histogram(df: DataFrame, value_col: str, bins: int = 40) -> DataFrame:
    """Equal-width histogram over [min, max]; the last bin is closed.

    The range is a one-row scalar subquery; binning is a narrow projection;
    the count is a grouped aggregate over at most ``bins`` keys. Empty bins
    are kept. A zero-width range is widened by 0.5 on each side.
    """
    rng = df.agg(F.min(value_col).alias("_lo0"), F.max(value_col).alias("_hi0"))
    rng = rng.select(
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_lo0") - 0.5).otherwise(F.col("_lo0")).alias("_lo"),
        F.when(F.col("_lo0") == F.col("_hi0"), F.col("_hi0") + 0.5).otherwise(F.col("_hi0")).alias("_hi"),
    )
    lo, hi = F.col("_lo"), F.col("_hi")
    width = (hi - lo) / F.lit(float(bins))

    def edge(i: F.Column) -> F.Column:
        return F.when(i == bins, hi).otherwise(lo + i * width)

    # The quotient may round across an edge, so the bin is held against its edges.
    v, guess = F.col(value_col), F.least(F.floor((F.col(value_col) - lo) / (hi - lo) * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    idx = guess - (v < edge(guess)).cast("int") + ((v >= edge(guess + 1)) & (guess < bins - 1)).cast("int")
    counts = attach_scalars(df.filter(F.col(value_col).isNotNull()).select(value_col), rng) \
        .select((idx + 1).alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    # ``all_bins`` has ``bins`` rows and ``counts`` at most ``bins``: both tiny.
    return (
        attach_scalars(all_bins, rng).join(counts, "bin", "left")
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
            (lo + F.col("bin") * width).alias("bin_hi"),
            F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        )
    )


def residual_histogram(residuals: DataFrame, bins: int = 40, value_col: str = "residual_musd") -> DataFrame:
    return histogram(residuals, value_col, bins)


# ---------------------------------------------------------------------------
# Model comparison and importances
# ---------------------------------------------------------------------------

def model_comparison_data(metrics: DataFrame, metric_names: Sequence[str] = ("MAE", "RMSE", "MAPE")) -> DataFrame:
    """Metrics in long form (Model, metric, value) for grouped bars."""
    return metrics.select("Model", *metric_names).unpivot("Model", list(metric_names), "metric", "value")


def top_features(importances: DataFrame, top_n: int = 15) -> DataFrame:
    """Highest ``top_n`` importances (a top-k, so the limit is the feature)."""
    return importances.orderBy(F.desc("importance"), "feature").limit(top_n)


# ---------------------------------------------------------------------------
# Inventory scatter
# ---------------------------------------------------------------------------

def plan_head(plan: DataFrame, top_n: int = 20, group_col: str = "Store") -> DataFrame:
    """First ``top_n`` plan rows in store order (a top-k)."""
    return plan.orderBy(group_col).limit(top_n)


def bubble_size(safety_col: str = "safety_stock", scale: float = 400.0, floor: float = 30.0) -> F.Column:
    """safety stock relative to the largest in view, scaled, at least ``floor``.
    The frame is the ``top_n`` head, so the unpartitioned max is tiny."""
    rel = safe_div(F.col(safety_col), F.max(safety_col).over(Window.partitionBy())) * F.lit(scale)
    return clip_lower(rel, floor)


def inventory_scatter_data(plan: DataFrame, top_n: int = 20) -> DataFrame:
    head = plan_head(plan, top_n)
    return head.select(
        "Store",
        in_millions("avg_weekly_demand").alias("avg_demand_musd"),
        in_millions("reorder_point").alias("reorder_point_musd"),
        "replenishment_alert",
        bubble_size().alias("bubble_size"),
    )


# ---------------------------------------------------------------------------
# Distribution by store type (box plot)
# ---------------------------------------------------------------------------

def quartiles_by_type(store_weekly: DataFrame, value_col: str = "Weekly_Sales", accuracy: int = 10_000) -> DataFrame:
    """Exact, linearly interpolated quartiles per type, in $M: (Type, n, q1,
    median, q3).

    A mergeable quantile sketch of fixed size brackets each wanted rank: a
    value it names for a share lies within ``1 / accuracy`` of that share. A
    second pass counts what lies below each bracket and keeps only the values
    inside (some ``30 / accuracy`` of the rows; all of a type of no more than
    ``accuracy`` rows), by which the rank is found.
    Both passes are partial aggregates; no type meets in one task. Were a
    rank outside its bracket, the query would fail rather than be wrong.
    """
    rows = store_weekly.filter(F.col(value_col).isNotNull()).select("Type", F.col(value_col).alias("_v"))
    slack = 5.0 / accuracy  # the sketch's error, and two ranks more from ``accuracy`` rows on
    shares = [x for q, _ in _QUARTILES for x in (max(0.0, q - slack), min(1.0, q + slack))]
    bounds = rows.groupBy("Type").agg(F.percentile_approx("_v", F.lit(shares), F.lit(accuracy)).alias("_b"), F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    whole = F.array(*[F.col("_min"), F.col("_max")] * len(_QUARTILES))
    bounds = bounds.select("Type", F.when(F.col("_n") <= accuracy, whole).otherwise(F.col("_b")).alias("_b"))
    names = [name for _, name in _QUARTILES]
    marks = [F.struct(F.lit(name).alias("name"), F.lit(q).alias("q"), F.col("_b")[2 * i].alias("lo"), F.col("_b")[2 * i + 1].alias("hi")) for i, (q, name) in enumerate(_QUARTILES)]
    joined = rows.join(bounds, rows["Type"].eqNullSafe(bounds["Type"])).drop(bounds["Type"])
    inside = [(F.col("_v") >= F.col("_b")[2 * i]) & (F.col("_v") <= F.col("_b")[2 * i + 1]) for i in range(len(names))]
    # one pass: a row for each value inside a bracket, all others by the gap they lie in
    gap = F.when(F.col("_v") < F.col("_b")[0], 0)
    for i in range(1, len(names)):
        gap = gap.when(F.col("_v") < F.col("_b")[2 * i], i)
    kept = F.when(_any(inside), F.col("_v"))
    counted = joined.groupBy("Type", "_b", kept.alias("_v"), F.when(kept.isNull(), gap.otherwise(len(names))).alias("_gap")).agg(F.count(F.lit(1)).alias("_c"))

    each = counted.withColumn("_m", F.explode(F.array(*marks))).select("Type", "_m.*", "_v", "_c", F.col("_gap"))
    order = {name: i for i, name in enumerate(names)}
    place = F.create_map(*[x for name, i in order.items() for x in (F.lit(name), F.lit(i))])[F.col("name")]
    below = F.when(F.col("_v").isNull(), F.col("_gap") <= place).otherwise(F.col("_v") < F.col("lo"))
    sizes = each.groupBy("Type", "name", "q").agg(F.sum("_c").alias("n"), F.sum(F.when(below, F.col("_c")).otherwise(0)).alias("_below"))
    at = each.filter((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))).select("Type", "name", "_v", "_c")
    upto = F.sum("_c").over(Window.partitionBy("Type", "name").orderBy("_v"))
    ranked = at.withColumn("_upto", upto).alias("a").join(sizes.alias("s"), F.col("a.Type").eqNullSafe(F.col("s.Type")) & (F.col("a.name") == F.col("s.name")))
    rank, seen = F.col("q") * (F.col("n") - 1), F.col("_below") + F.col("_upto")
    found = ranked.groupBy("s.Type", "s.name", "q", "n", "_below").agg(
        F.min(F.when(seen > F.floor(rank), F.col("_v"))).alias("_lo"), F.min(F.when(seen > F.ceil(rank), F.col("_v"))).alias("_hi"))
    held = (F.col("_below") <= F.floor(rank)) & F.col("_hi").isNotNull()
    value = F.when(held, F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (rank - F.floor(rank))).otherwise(F.raise_error(F.lit("a quartile lies outside its bracket")).cast("double"))
    return found.groupBy("Type", "n").agg(*[in_millions(F.max(F.when(F.col("name") == name, value))).alias(name) for name in names])


def _any(conditions: list) -> F.Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


_QUARTILES = ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))


def sales_distribution_by_type(store_weekly: DataFrame, whisker: float = 1.5, value_col: str = "Weekly_Sales") -> DataFrame:
    """Per type: exact quartiles, whiskers (furthest points within ``whisker``
    x IQR), counts and outlier count, in $M."""
    quart = materialize(quartiles_by_type(store_weekly, value_col), "quartiles")
    reach = F.lit(whisker) * (F.col("q3") - F.col("q1"))
    fences = quart.select("Type", (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi"))
    joined = store_weekly.select("Type", in_millions(value_col).alias("_v")).join(fences, "Type")
    inside = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    spans = joined.groupBy("Type").agg(
        F.min(F.when(inside, F.col("_v"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_v"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )
    return quart.join(spans, "Type").select("Type", "q1", "median", "q3", "whisker_lo", "whisker_hi", "n", "n_outliers")


def sales_outliers_by_type(store_weekly: DataFrame, whisker: float = 1.5, value_col: str = "Weekly_Sales", box: DataFrame | None = None) -> DataFrame:
    """The rows drawn as outlier points in the box plot; ``box`` is the
    distribution where it is at hand."""
    box = sales_distribution_by_type(store_weekly, whisker, value_col) if box is None else box
    v = in_millions(value_col)
    return (
        store_weekly.select("Store", "Date", "Type", v.alias("sales_musd"))
        .join(box.select("Type", "whisker_lo", "whisker_hi"), "Type")
        .filter((F.col("sales_musd") < F.col("whisker_lo")) | (F.col("sales_musd") > F.col("whisker_hi")))
        .drop("whisker_lo", "whisker_hi")
    )
