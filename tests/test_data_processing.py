import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.operators.baselines import MovingAverageForecaster, NaiveForecaster
from demand_engine.operators.clean import build_store_weekly, clean_sales
from demand_engine.operators.features import add_lag_features, add_store_features, add_time_features
from demand_engine.operators.split import cutoff_info, train_holdout_split

PANEL = "Store long, Date date, Type string, Size long, IsHoliday boolean, Weekly_Sales double"
SALES = "Store long, Date date, Weekly_Sales double, IsHoliday boolean"
STORES = "Store long, Type string, Size long"


def make_panel(spark, n=20, size=100_000):
    start = dt.date(2020, 1, 5)  # 20 Sundays from here
    sales = np.linspace(1000, 2000, n)
    rows = [(1, start + dt.timedelta(weeks=i), "A", size, False, float(sales[i])) for i in range(n)]
    return spark.createDataFrame(rows, PANEL)


class TestDataProcessing:
    def test_add_time_features_columns(self, spark):
        out = add_time_features(make_panel(spark))
        for col in ("year", "month", "week_of_year", "trend", "week_sin", "week_cos"):
            assert col in out.columns
        r = out.orderBy("Date").collect()
        assert r[0]["trend"] == 0 and r[5]["trend"] == 5
        assert r[0]["week_sin"] == pytest.approx(math.sin(2 * math.pi * r[0]["week_of_year"] / 52))

    def test_add_store_features_type_code(self, spark):
        out = add_store_features(make_panel(spark))
        assert "type_code" in out.columns
        assert out.first()["type_code"] == 0

    def test_lag_features_no_future_leakage(self, spark):
        rows = add_lag_features(make_panel(spark), lags=[1]).orderBy("Date").collect()
        assert rows[0]["sales_lag_1"] is None
        assert rows[1]["sales_lag_1"] == pytest.approx(rows[0]["Weekly_Sales"])

    def _split(self, spark):
        df = add_lag_features(make_panel(spark), lags=[1], windows=())
        return train_holdout_split(df, holdout_weeks=4)

    def test_train_holdout_split_sizes(self, spark):
        train, holdout = self._split(spark)
        assert holdout.count() == 4 and train.count() == 15  # first row lacks lag 1
        assert train.agg(F.max("Date")).first()[0] < holdout.agg(F.min("Date")).first()[0]

    def test_holdout_no_future_dates_in_train(self, spark):
        train, holdout = self._split(spark)
        assert train.agg(F.max("Date")).first()[0] < holdout.agg(F.min("Date")).first()[0]

    def test_forecast_output_shape(self, spark):
        df = add_lag_features(make_panel(spark))
        train, holdout = train_holdout_split(df, holdout_weeks=4)
        m = MovingAverageForecaster(4).fit(train)
        out = m.predict(holdout)
        assert out.count() == holdout.count()
        assert m.output_col == "pred_Moving_Average_4w"


# --- traps ------------------------------------------------------------------

def test_sales_dirty(spark):
    rows = [(1, dt.date(2020, 1, 6), v, False) for v in (-5.0, 0.0, None, float("nan"), 3.5)]
    kept = sorted(r["Weekly_Sales"] for r in clean_sales(spark.createDataFrame(rows, SALES)).collect())
    assert kept == [0.0, 3.5]


def test_unknown_store_and_null_type_vanish(spark):
    d = dt.date(2020, 1, 6)
    sales = spark.createDataFrame([(1, d, 10.0, False), (2, d, 20.0, False), (3, d, 30.0, False)], SALES)
    stores = spark.createDataFrame([(1, "A", 100), (3, None, 100)], STORES)
    out = build_store_weekly(sales, stores).collect()
    assert [(r["Store"], r["Weekly_Sales"]) for r in out] == [(1, 10.0)]


def test_duplicated_store_doubles_sales(spark):
    d = dt.date(2020, 1, 6)
    sales = spark.createDataFrame([(1, d, 10.0, False), (1, d, 5.0, False)], SALES)
    stores = spark.createDataFrame([(1, "A", 100), (1, "A", 100)], STORES)
    assert build_store_weekly(sales, stores).first()["Weekly_Sales"] == 30.0


def test_holiday_conflict_gives_two_rows_in_stable_order(spark):
    d0, d1 = dt.date(2020, 1, 6), dt.date(2020, 1, 13)
    sales = spark.createDataFrame([(1, d0, 1.0, False), (1, d1, 2.0, True), (1, d1, 3.0, False)], SALES)
    stores = spark.createDataFrame([(1, "A", 100)], STORES)
    sw = build_store_weekly(sales, stores)
    assert sw.count() == 3
    rows = add_lag_features(sw, lags=[1], windows=()).orderBy("Date", "IsHoliday").collect()
    # order inside the week is IsHoliday false then true
    assert [(r["Weekly_Sales"], r["sales_lag_1"]) for r in rows] == [(1.0, None), (3.0, 1.0), (2.0, 3.0)]


def test_gappy_series_lags_by_row(spark):
    base = dt.date(2020, 1, 6)
    rows = [(1, base + dt.timedelta(weeks=w - 1), "A", 1, False, float(w)) for w in (1, 2, 5, 6)]
    out = add_lag_features(spark.createDataFrame(rows, PANEL), lags=[1], windows=()).orderBy("Date").collect()
    assert out[2]["Weekly_Sales"] == 5.0 and out[2]["sales_lag_1"] == 2.0


def test_iso_week_53_and_month_end(spark):
    days = [dt.date(2010, 1, 3), dt.date(2012, 1, 1), dt.date(2012, 2, 29), dt.date(2012, 12, 31)]
    df = spark.createDataFrame([(1, d, "A", 1, False, 1.0) for d in days], PANEL)
    rows = add_time_features(df).orderBy("Date").collect()
    assert [r["week_of_year"] for r in rows] == [53, 52, 9, 1]
    assert [r["is_month_end"] for r in rows] == [0, 0, 1, 1]


def test_type_unknown_strict_and_lenient(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 6), "Z", 1, False, 1.0)], PANEL)
    assert add_store_features(df, strict=False).first()["type_code"] is None
    with pytest.raises(Exception, match="unknown store type"):
        add_store_features(df, strict=True).collect()


def test_constant_size_empties_split(spark):
    df = add_store_features(add_lag_features(make_panel(spark)))
    assert df.filter(F.col("size_norm").isNotNull()).count() == 0
    train, holdout = train_holdout_split(df, holdout_weeks=4)
    assert train.count() == 0 and holdout.count() == 0


def test_short_history_errors(spark):
    df = make_panel(spark, n=3)
    with pytest.raises(Exception, match="distinct dates"):
        cutoff_info(df, 3).collect()
    with pytest.raises(ValueError):
        cutoff_info(df, 0)
    r = cutoff_info(df, 2).first()
    assert r["cutoff_date"] == dt.date(2020, 1, 12) and r["last_train_date"] == dt.date(2020, 1, 5)


def test_naive_uses_last_value_and_zero_for_unknown(spark):
    train = spark.createDataFrame([(1, dt.date(2020, 1, 6), "A", 1, False, 5.0),
                                   (1, dt.date(2020, 1, 13), "A", 1, False, 7.0),
                                   (1, dt.date(2020, 1, 20), "A", 1, False, None)], PANEL)
    hold = spark.createDataFrame([(1, dt.date(2020, 2, 3), "A", 1, False, 1.0),
                                  (9, dt.date(2020, 2, 3), "A", 1, False, 1.0)], PANEL)
    m = NaiveForecaster().fit(train)
    rows = {r["Store"]: r[m.output_col] for r in m.predict(hold).collect()}
    assert rows == {1: 7.0, 9: 0.0}


def test_moving_average_needs_feature(spark):
    with pytest.raises(ValueError):
        MovingAverageForecaster(5).fit(None).predict(make_panel(spark))
