"""Ridge regression from one aggregate, and gradient-boosted trees on Spark ML.

Fitting is an action; prediction stays lazy. Feature vectors are built
JVM-side with ``array_to_vector`` (no Python per row). The rows for the
iterative tree fit are written to the shared checkpoint folder once, so a
lost executor re-reads them instead of re-running the feature plan.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LINEAR_FEATURES, RIDGE_ALPHA, RIDGE_NAME, TREE_FEATURES, TREES_NAME, TreeParams
from ..functions.formatting import prediction_column_name
from ..functions.nulls import clip_negative, fill_zero
from ..session import ensure_checkpoint_dir
from .boosting import early_stop
from .split import validation_flag

VEC = "_features"
RAW = "_raw_prediction"


def select_linear_features(df: DataFrame, features: Sequence[str] = LINEAR_FEATURES,
                           keep: Sequence[str] = ()) -> DataFrame:
    """The ridge inputs, missing -> 0; a missing column is an error."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing feature columns: {absent}")
    return df.select(*keep, *[fill_zero(c).alias(c) for c in features])


def available_tree_features(df: DataFrame, features: Sequence[str] = TREE_FEATURES) -> list[str]:
    return [c for c in features if c in df.columns]


def select_tree_features(df: DataFrame, features: Sequence[str] = TREE_FEATURES,
                         keep: Sequence[str] = ()) -> DataFrame:
    """The tree inputs that exist (absent ones are skipped), missing -> 0."""
    return df.select(*keep, *[fill_zero(c).alias(c) for c in available_tree_features(df, features)])


def feature_vector(cols: Sequence[str]) -> Column:
    return array_to_vector(F.array(*[fill_zero(c) for c in cols]))


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str] = LINEAR_FEATURES,
                   keep: Sequence[str] = ()) -> DataFrame:
    """(x - mean) / population std with moments from ``train``; a constant
    column is only centred (scale 1). Missing -> 0 before scaling."""
    g = gram(train, cols)
    out = []
    for i, c in enumerate(cols):
        s = float(np.sqrt(max(g["cov"][i, i], 0.0)))
        out.append(((fill_zero(c) - F.lit(float(g["mean"][i]))) / F.lit(s if s > 0 else 1.0)).alias(c))
    return df.select(*keep, *out)


ROW_KEYS = ("Store", "Date", "IsHoliday", "Type", "Size")


def training_frame(df: DataFrame, keys: Sequence[str], rows_per_partition: int) -> DataFrame:
    """Tree inputs in a layout that depends on the rows alone.

    Spark's tree learner samples split candidates per partition, so the rows
    are hash-partitioned on the first key into ``rows / rows_per_partition``
    partitions and sorted by all keys (which are then dropped): neither the
    cores nor upstream stages change the model, and partitions do not grow
    with the data. The frame is checkpointed to the shared folder (a file
    reader would deal the rows by the number of cores), so iterative fitting
    re-reads files and a lost executor costs no re-run of the feature plan. A
    store holds one row per week, so no partition is hot.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [k for k in keys if k in df.columns]
    parts = max(1, -(-df.count() // rows_per_partition))
    return df.repartition(parts, keys[0]).sortWithinPartitions(*keys).drop(*keys).checkpoint(eager=True)


# ---------------------------------------------------------------------------
# Ridge
# ---------------------------------------------------------------------------

def gram(df: DataFrame, cols: Sequence[str], target: str | None = None) -> dict:
    """Count, means and covariances (population) of the columns, missing as 0,
    and of the target: one native aggregate with partial sums, whose result
    is one row. What the scaler and the normal equations need."""
    x = [fill_zero(c) for c in cols] + ([F.col(target).cast("double")] if target else [])
    n = len(x)
    out = df.agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.avg(v) for v in x]).alias("mean"),
        F.array(*[F.covar_pop(x[i], x[j]) for i in range(n) for j in range(i + 1)]).alias("cov"),
    ).first()
    cov = np.zeros((n, n))
    if out["n"]:
        cov[np.tril_indices(n)] = out["cov"]
    return {"n": out["n"], "mean": np.array([v or 0.0 for v in out["mean"]]), "cov": cov + np.tril(cov, -1).T}


@dataclass
class RidgeModel:
    features: list[str]
    weights: list[float]
    intercept: float
    name: str = RIDGE_NAME

    @property
    def output_col(self) -> str:
        return prediction_column_name(self.name)

    def predict(self, df: DataFrame) -> DataFrame:
        total = F.lit(self.intercept)
        for c, w in zip(self.features, self.weights, strict=True):
            total = total + F.lit(w) * fill_zero(c)
        return df.withColumn(self.output_col, clip_negative(total))

    def coefficients(self) -> dict[str, float]:
        return dict(zip(self.features, self.weights, strict=True))


class RidgeForecaster:
    """L2-penalised least squares on standardised features.

    Penalty ``alpha * ||w||^2`` on population-standardised features with an
    unpenalised intercept. One aggregate over the rows gives the means and
    covariances; the system (features x features) is solved on the driver.
    A constant feature gets no weight.
    """

    name = RIDGE_NAME

    def __init__(self, alpha: float = RIDGE_ALPHA, features: Sequence[str] = LINEAR_FEATURES,
                 target: str = "Weekly_Sales"):
        self.alpha = alpha
        self.features = list(features)
        self.target = target

    def fit(self, train: DataFrame) -> RidgeModel:
        absent = [c for c in self.features if c not in train.columns]
        if absent:
            raise ValueError(f"missing feature columns: {absent}")
        g = gram(train.where(F.col(self.target).isNotNull()), self.features, self.target)
        k, weights = len(self.features), np.zeros(len(self.features))
        if not g["n"]:
            return RidgeModel(self.features, weights.tolist(), 0.0, self.name)
        scale = np.sqrt(np.maximum(np.diag(g["cov"])[:k], 0.0))
        use = np.flatnonzero(scale > 1e-12 * np.maximum(1.0, np.abs(g["mean"][:k])))
        if len(use):
            s = scale[use]
            system = g["cov"][np.ix_(use, use)] / np.outer(s, s) + self.alpha / g["n"] * np.eye(len(use))
            weights[use] = np.linalg.solve(system, g["cov"][use, k] / s) / s
        return RidgeModel(self.features, weights.tolist(), float(g["mean"][k] - weights @ g["mean"][:k]), self.name)


# ---------------------------------------------------------------------------
# Gradient-boosted trees
# ---------------------------------------------------------------------------

def best_iteration(losses: Sequence[float], patience: int) -> int:
    return early_stop(losses, patience)[0]


@dataclass
class TreesModel:
    features: list[str]
    model: GBTRegressionModel
    n_trees: int
    validation_losses: list[float] = field(default_factory=list)
    name: str = TREES_NAME

    @property
    def output_col(self) -> str:
        return prediction_column_name(self.name)

    def predict(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df.withColumn(VEC, feature_vector(self.features)))
        return scored.withColumn(self.output_col, clip_negative(RAW)).drop(VEC, RAW)

    def feature_importances(self) -> list[tuple[str, float, int]]:
        """(feature, importance, splits) sorted descending: Spark's impurity
        gains (they sum to 1) and how many splits use the feature."""
        gains = self.model.featureImportances.toArray().tolist()
        splits = Counter(int(i) for tree in self.model.trees for i in _SPLIT.findall(tree.toDebugString))
        rows = [(f, g, splits[i]) for i, (f, g) in enumerate(zip(self.features, gains))]
        return sorted(rows, key=lambda t: (-t[1], t[0]))

    def feature_importances_df(self, spark) -> DataFrame:
        """One row per feature (bounded by the feature list)."""
        return spark.createDataFrame(self.feature_importances(), "feature string, importance double, splits long")


_SPLIT = re.compile(r"If \(feature (\d+) ")


def prefix_model(model: GBTRegressionModel, keep: int) -> GBTRegressionModel:
    """The ensemble of the first ``keep`` trees: rounds only add trees, so
    this is the model that a fit of ``keep`` rounds gives."""
    if keep >= model.getNumTrees:
        return model
    full = model._java_obj
    gateway = SparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    weights = gateway.new_array(gateway.jvm.double, keep)
    fitted, rates = full.trees(), full.treeWeights()
    for i in range(keep):
        trees[i], weights[i] = fitted[i], rates[i]
    cut = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(full.uid(), trees, weights, full.numFeatures())
    cut.setFeaturesCol(VEC)
    cut.setPredictionCol(RAW)
    return GBTRegressionModel(cut)


class BoostedTreesForecaster:
    """Gradient-boosted regression trees grown level by level by Spark ML,
    with early stopping (``boosting.LeafTreesForecaster`` grows by leaf).

    Trees are fitted on the non-validation training rows up to ``max_iter``;
    the validation loss of every prefix is computed in one pass
    (``evaluateEachIteration``); the best prefix under the patience rule is
    made of the fitted trees, without another fit.
    """

    name = TREES_NAME

    def __init__(self, params: TreeParams | None = None, features: Sequence[str] = TREE_FEATURES,
                 target: str = "Weekly_Sales"):
        self.params = params or TreeParams()
        self.features = list(features)
        self.target = target

    def _estimator(self, max_iter: int) -> GBTRegressor:
        p = self.params
        return GBTRegressor(
            featuresCol=VEC, labelCol=self.target, predictionCol=RAW, lossType="squared",
            maxIter=max_iter, stepSize=p.step_size, maxDepth=p.max_depth,
            minInstancesPerNode=p.min_instances_per_node, featureSubsetStrategy=str(p.feature_subset),
            subsamplingRate=p.subsampling_rate, seed=p.seed, maxBins=p.max_bins,
            checkpointInterval=p.checkpoint_interval,
        )

    def fit(self, train: DataFrame) -> TreesModel:
        """Fit a first chunk of ``patience + 16`` rounds; while the patience
        rule has not fired, fit a longer chunk (at least double, and past the
        best round so far by the patience window), up to the cap. The model
        is the best prefix of the last fit.

        With a fixed seed a fit of k rounds is an exact prefix of a longer
        fit, so this gives the same model as fitting the full cap. When the
        best round comes early only the first chunk is paid; in the worst
        case the chunks add up to about twice the cap (Spark's learner cannot
        continue a fit).
        """
        p = self.params
        cols = available_tree_features(train, self.features)
        flagged = validation_flag(train, p.validation_fraction, p.validation_mode)
        keys = [k for k in ROW_KEYS if k in flagged.columns]
        data = training_frame(flagged.select(
            *keys, feature_vector(cols).alias(VEC), F.col(self.target).cast("double").alias(self.target), "is_validation",
        ), keys, p.rows_per_partition)
        fit_rows = data.filter(~F.col("is_validation"))
        val_rows = data.filter(F.col("is_validation"))
        rounds = min(p.max_iter, p.early_stopping_rounds + 16)
        while True:
            model = self._estimator(rounds).fit(fit_rows)
            losses = [float(x) for x in model.evaluateEachIteration(val_rows, "squared")]
            keep, stopped = early_stop(losses, p.early_stopping_rounds) if losses else (rounds, False)
            if stopped or rounds >= p.max_iter:
                break
            # Not settled yet: at least double, and reach past the best round
            # seen so far by the patience window.
            rounds = min(p.max_iter, max(2 * rounds, keep + p.early_stopping_rounds + 16))
        return TreesModel(cols, prefix_model(model, keep), keep, losses, self.name)
