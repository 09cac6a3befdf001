import math

import pytest

from demand_engine.operators.evaluation import VS_WORST_COL, compare_models, evaluate_long


def _eval(spark, actual, predicted, name="m", digits=None):
    df = spark.createDataFrame([(name, float(a), float(p)) for a, p in zip(actual, predicted)],
                               "Model string, actual double, predicted double")
    return evaluate_long(df, digits=digits).first().asDict()


class TestMetrics:
    def test_mae_perfect(self, spark):
        assert _eval(spark, [1, 2, 3], [1, 2, 3])["MAE"] == pytest.approx(0.0)

    def test_mae_known(self, spark):
        assert _eval(spark, [10, 20], [12, 18])["MAE"] == pytest.approx(2.0)

    def test_rmse_perfect(self, spark):
        assert _eval(spark, [5, 10, 15], [5, 10, 15])["RMSE"] == pytest.approx(0.0)

    def test_rmse_known(self, spark):
        assert _eval(spark, [0, 4], [3, 0])["RMSE"] == pytest.approx(math.sqrt(12.5), rel=1e-4)

    def test_mape_zero_actuals_excluded(self, spark):
        assert _eval(spark, [0, 100], [10, 110])["MAPE"] == pytest.approx(10.0, rel=1e-4)

    def test_r2_perfect(self, spark):
        a = list(range(10))
        assert _eval(spark, a, a)["R2"] == pytest.approx(1.0)

    def test_r2_mean_prediction(self, spark):
        assert _eval(spark, [1, 2, 3], [2, 2, 2])["R2"] == pytest.approx(0.0)

    def test_evaluate_returns_all_keys(self, spark):
        r = _eval(spark, [100, 200, 300], [110, 210, 310], name="test_model")
        for k in ("Model", "MAE", "RMSE", "MAPE", "R2"):
            assert k in r

    def test_compare_models_sorted_by_rmse(self, spark):
        m = spark.createDataFrame([("A", 10.0, 20.0, 5.0, 0.9), ("B", 5.0, 10.0, 2.5, 0.95)],
                                  "Model string, MAE double, RMSE double, MAPE double, R2 double")
        rows = compare_models(m).orderBy("Rank").collect()
        assert rows[0]["Model"] == "B" and rows[0]["Rank"] == 1
        # compared with the worst model (A): (20 - 10) / 20
        assert rows[0][VS_WORST_COL] == pytest.approx(50.0)
        assert rows[1][VS_WORST_COL] == pytest.approx(0.0)


def test_all_zero_actuals_give_null(spark):
    r = _eval(spark, [0, 0], [1, 2])
    assert r["MAPE"] is None and r["R2"] is None


def test_rounding_digits(spark):
    r = _eval(spark, [100, 200, 300], [101.234, 199.1, 305.55], digits={"MAE": 2, "RMSE": 2, "MAPE": 2, "R2": 4})
    assert r["MAE"] == round((1.234 + 0.9 + 5.55) / 3, 2)
    assert r["R2"] == pytest.approx(round(r["R2"], 4))


def test_all_models_one_pass(spark):
    from demand_engine.operators.evaluation import evaluate_models

    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 2.0)], "actual double, p1 double, p2 double")
    rows = {r["Model"]: r for r in evaluate_models(df, {"one": "p1", "two": "p2"}).collect()}
    assert rows["one"]["MAE"] == 0.0 and rows["two"]["MAE"] == 0.5
