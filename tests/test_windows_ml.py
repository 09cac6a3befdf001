"""Property tests: windows against pandas, ridge against the closed form,
validation modes against a sorted brute force, trees for sanity."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demand_engine.config import TreeParams
from demand_engine.operators.features import add_lag_features
from demand_engine.operators.ml import BoostedTreesForecaster, RidgeForecaster, best_iteration, standard_scale
from demand_engine.operators.split import validation_flag


def test_rolling_panel_matches_pandas(spark):
    rng = np.random.default_rng(7)
    base = dt.date(2020, 1, 6)
    rows = [(s, base + dt.timedelta(weeks=t), float(rng.normal(100, 20))) for s in (1, 2, 3) for t in range(30)]
    pdf = pd.DataFrame(rows, columns=["Store", "Date", "Weekly_Sales"])
    df = spark.createDataFrame(pdf, "Store long, Date date, Weekly_Sales double")
    out = add_lag_features(df).toPandas().sort_values(["Store", "Date"]).reset_index(drop=True)
    exp = pdf.sort_values(["Store", "Date"]).reset_index(drop=True)
    g = exp.groupby("Store")["Weekly_Sales"]
    for k in (1, 2, 4, 12):
        np.testing.assert_allclose(out[f"sales_lag_{k}"].astype(float), g.shift(k).astype(float), equal_nan=True)
    for k in (4, 12):
        ref = g.transform(lambda s, k=k: s.shift(1).rolling(k, min_periods=1).mean())
        np.testing.assert_allclose(out[f"sales_roll_{k}"].astype(float), ref.astype(float), rtol=1e-12, equal_nan=True)


def _ridge_panel(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3)) * np.array([1.0, 5.0, 0.2]) + np.array([0.0, 3.0, -1.0])
    y = 2.0 + X @ np.array([1.5, -0.7, 4.0]) + rng.normal(scale=0.5, size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(y=y)
    return spark.createDataFrame(pdf), X, y


def test_ridge_matches_closed_form(spark):
    df, X, y = _ridge_panel(spark)
    alpha = 10.0
    mu, sd = X.mean(axis=0), X.std(axis=0)
    Z = (X - mu) / sd
    yc = y - y.mean()
    w = np.linalg.solve(Z.T @ Z + alpha * np.eye(3), Z.T @ yc)
    expected = np.maximum((Z @ w) + y.mean(), 0)
    m = RidgeForecaster(alpha=alpha, features=["a", "b", "c"], target="y").fit(df)
    got = m.predict(df.withColumn("_i", F.monotonically_increasing_id())).orderBy("_i").toPandas()[m.output_col]
    np.testing.assert_allclose(got.to_numpy(), expected, rtol=1e-8, atol=1e-8)


def test_ridge_constant_target(spark):
    df = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, y double")
    m = RidgeForecaster(features=["a"], target="y").fit(df)
    assert {r[m.output_col] for r in m.predict(df).collect()} == {5.0}


def test_standard_scale_population_std(spark):
    df, X, _ = _ridge_panel(spark, n=50)
    got = standard_scale(df, df, ["a", "b", "c"]).toPandas().to_numpy()
    np.testing.assert_allclose(got, (X - X.mean(axis=0)) / X.std(axis=0), rtol=1e-9, atol=1e-9)


def test_best_iteration_patience():
    assert best_iteration([5, 4, 3, 4, 5], patience=2) == 3
    assert best_iteration([5, 4, 6, 7, 1], patience=2) == 2   # stops before the late dip
    assert best_iteration([5, 4, 6, 7, 1], patience=5) == 5


def _train_panel(spark, stores=7, weeks=15, seed=1):
    rng = np.random.default_rng(seed)
    base = dt.date(2020, 1, 6)
    rows = [(s, base + dt.timedelta(weeks=int(t)), bool(rng.integers(0, 2)), "A", 10, float(rng.normal()))
            for s in range(stores) for t in sorted(rng.choice(30, size=weeks, replace=False))]
    return spark.createDataFrame(rows, "Store long, Date date, IsHoliday boolean, Type string, Size long, Weekly_Sales double")


def test_validation_tail_rows_matches_sorted_tail(spark):
    df = _train_panel(spark)
    pdf = df.toPandas().sort_values(["Store", "Date", "IsHoliday", "Type", "Size"]).reset_index(drop=True)
    n_val = max(1, int(len(pdf) * 0.1))
    expected = set(map(tuple, pdf.iloc[-n_val:][["Store", "Date"]].astype(str).to_numpy()))
    got = validation_flag(df, 0.1, "tail_rows")
    marked = {(str(r["Store"]), str(r["Date"])) for r in got.filter("is_validation").collect()}
    assert marked == expected


def test_validation_chronological_whole_dates(spark):
    df = _train_panel(spark)
    pdf = df.toPandas()
    n_val = max(1, int(len(pdf) * 0.1))
    counts = pdf.groupby("Date").size().sort_index(ascending=False).cumsum()
    boundary = counts[counts >= n_val].index[0]
    got = validation_flag(df, 0.1, "chronological").toPandas()
    assert set(got[got.is_validation]["Date"]) == set(pdf[pdf.Date >= boundary]["Date"])
    assert got.is_validation.sum() >= n_val


def test_trees_learn_signal_and_are_deterministic(spark):
    rng = np.random.default_rng(0)
    base = dt.date(2020, 1, 6)
    rows = []
    for s in range(20):
        level = 1000.0 * (s % 4 + 1)
        for t in range(40):
            x = float(rng.normal())
            rows.append((s, base + dt.timedelta(weeks=t), False, "A", 10, level + 300 * x + float(rng.normal(0, 10)), x))
    df = spark.createDataFrame(rows, "Store long, Date date, IsHoliday boolean, Type string, Size long, "
                                     "Weekly_Sales double, sales_lag_1 double")
    params = TreeParams(max_iter=15, step_size=0.3, min_instances_per_node=5, early_stopping_rounds=5)
    m1 = BoostedTreesForecaster(params, features=["sales_lag_1", "Store"]).fit(df)
    m2 = BoostedTreesForecaster(params, features=["sales_lag_1", "Store"]).fit(df)
    p1 = m1.predict(df).select(m1.output_col, "Weekly_Sales").toPandas()
    p2 = m2.predict(df).select(m2.output_col).toPandas()
    np.testing.assert_allclose(p1[m1.output_col], p2[m2.output_col])
    mse = ((p1[m1.output_col] - p1["Weekly_Sales"]) ** 2).mean()
    assert mse < p1["Weekly_Sales"].var() * 0.5
    imp = {f: gain for f, gain, _ in m1.feature_importances()}
    assert all((splits > 0) == (gain > 0) for _, gain, splits in m1.feature_importances())
    assert set(imp) == {"sales_lag_1", "Store"} and abs(sum(imp.values()) - 1) < 1e-9


def _signal_panel(spark, stores=12, weeks=30, seed=4):
    rng = np.random.default_rng(seed)
    base = dt.date(2020, 1, 6)
    rows = []
    for s in range(stores):
        for t in range(weeks):
            x = float(rng.normal())
            rows.append((s, base + dt.timedelta(weeks=t), False, "A", 10, 1000.0 + 200 * x + float(rng.normal(0, 50)), x))
    return spark.createDataFrame(rows, "Store long, Date date, IsHoliday boolean, Type string, Size long, "
                                       "Weekly_Sales double, sales_lag_1 double")


def test_shorter_fit_is_exact_prefix(spark):
    df = _signal_panel(spark)
    f = BoostedTreesForecaster(TreeParams(max_iter=8, step_size=0.3, min_instances_per_node=5),
                               features=["sales_lag_1", "Store"])
    from demand_engine.operators.ml import VEC, feature_vector
    data = df.select(feature_vector(["sales_lag_1", "Store"]).alias(VEC), "Weekly_Sales")
    short, long_ = f._estimator(4).fit(data), f._estimator(8).fit(data)
    def body(t):  # the first line carries the model uid
        return t.toDebugString.split("\n", 1)[1]

    assert [body(t) for t in short.trees] == [body(t) for t in long_.trees[:4]]
    assert list(short.treeWeights) == list(long_.treeWeights[:4])


def test_chunked_early_stopping_equals_full_fit(spark):
    from demand_engine.operators.ml import VEC, early_stop, feature_vector

    df = _signal_panel(spark)
    params = TreeParams(max_iter=40, step_size=0.5, min_instances_per_node=5, early_stopping_rounds=3,
                        validation_fraction=0.2)
    feats = ["sales_lag_1", "Store"]
    chunked = BoostedTreesForecaster(params, features=feats).fit(df)
    # Brute force: fit the whole cap once and apply the patience rule.
    f = BoostedTreesForecaster(params, features=feats)
    flagged = validation_flag(df, params.validation_fraction, params.validation_mode)
    data = flagged.select(feature_vector(feats).alias(VEC), "Weekly_Sales", "is_validation")
    full = f._estimator(params.max_iter).fit(data.filter(~F.col("is_validation")))
    losses = full.evaluateEachIteration(data.filter(F.col("is_validation")), "squared")
    assert chunked.n_trees == early_stop(losses, params.early_stopping_rounds)[0]


def test_trees_do_not_depend_on_input_partitioning(spark):
    df = _signal_panel(spark)
    params = TreeParams(max_iter=12, step_size=0.3, min_instances_per_node=5, early_stopping_rounds=4)
    feats = ["sales_lag_1", "Store"]
    a = BoostedTreesForecaster(params, features=feats).fit(df.repartition(3))
    b = BoostedTreesForecaster(params, features=feats).fit(df.repartition(7, "Date"))
    assert a.n_trees == b.n_trees and a.validation_losses == b.validation_losses
    pa = a.predict(df).orderBy("Store", "Date").select(a.output_col).toPandas()
    pb = b.predict(df).orderBy("Store", "Date").select(b.output_col).toPandas()
    np.testing.assert_array_equal(pa.to_numpy(), pb.to_numpy())
