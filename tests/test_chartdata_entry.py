"""Chart data against NumPy, the streaming form of the store-week sum,
and the driver contract on the smallest driver tables."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.operators import chartdata as charts


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=500)
    df = spark.createDataFrame([(float(v),) for v in x], "r double")
    h = charts.histogram(df, "r", 40).orderBy("bin").toPandas()
    counts, edges = np.histogram(x, bins=40)
    assert h["n"].tolist() == counts.tolist()
    np.testing.assert_allclose(h["bin_lo"], edges[:-1], rtol=1e-9, atol=1e-12)
    assert h["n"].sum() == 500


def test_histogram_constant_values(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "r double")
    h = charts.histogram(df, "r", 4).orderBy("bin").toPandas()
    counts, _ = np.histogram(np.full(5, 2.0), bins=4)
    assert h["n"].tolist() == counts.tolist()


def _box_rows(spark):
    rng = np.random.default_rng(9)
    rows = [("A", float(v)) for v in rng.lognormal(13, 0.5, 300)] + [("B", float(v)) for v in rng.normal(1e6, 2e5, 200)]
    d = dt.date(2020, 1, 6)
    full = [(i, d, t, v) for i, (t, v) in enumerate(rows)]
    return rows, spark.createDataFrame(full, "Store long, Date date, Type string, Weekly_Sales double")


def test_box_plot_exact_matches_numpy(spark):
    rows, df = _box_rows(spark)
    got = {r["Type"]: r for r in charts.sales_distribution_by_type(df).collect()}
    for t in ("A", "B"):
        v = np.array([x for k, x in rows if k == t]) / 1e6
        q1, med, q3 = np.percentile(v, [25, 50, 75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= lo) & (v <= hi)]
        r = got[t]
        assert r["q1"] == pytest.approx(q1) and r["median"] == pytest.approx(med) and r["q3"] == pytest.approx(q3)
        assert r["whisker_lo"] == pytest.approx(inside.min()) and r["whisker_hi"] == pytest.approx(inside.max())
        assert r["n_outliers"] == len(v) - len(inside)
    outliers = charts.sales_outliers_by_type(df).count()
    assert outliers == sum(got[t]["n_outliers"] for t in got)


def test_box_plot_counts_ties_and_single_rows(spark):
    d = dt.date(2020, 1, 6)
    rows = [(i, d, "A", 5.0) for i in range(50)] + [(50, d, "A", 7.0), (51, d, "B", 3.0), (52, d, "C", None)]
    df = spark.createDataFrame(rows, "Store long, Date date, Type string, Weekly_Sales double")
    got = {r["Type"]: r for r in charts.quartiles_by_type(df).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"]["n"] == 51 and got["A"]["q1"] == got["A"]["q3"] == pytest.approx(5e-6)
    assert got["B"]["median"] == pytest.approx(3e-6)


@pytest.mark.parametrize("accuracy", [100, 1_000])
def test_quartiles_between_brackets(spark, accuracy):
    rng = np.random.default_rng(accuracy)
    groups = {"A": rng.normal(size=5_001), "B": rng.integers(0, 4, 3_000).astype(float), "C": rng.exponential(size=accuracy + 1), "D": rng.normal(size=accuracy), "E": np.array([2.0]), None: rng.normal(size=1_203).round(1)}
    rows = [(t, float(x) * 1e6) for t, v in groups.items() for x in v]
    got = {r["Type"]: r for r in charts.quartiles_by_type(spark.createDataFrame(rows, "Type string, Weekly_Sales double").repartition(5), accuracy=accuracy).collect()}
    assert set(got) == set(groups)
    for t, v in groups.items():
        assert got[t]["n"] == len(v)
        np.testing.assert_allclose([got[t][c] for c in ("q1", "median", "q3")], np.quantile(v, [0.25, 0.5, 0.75]), rtol=1e-9, atol=1e-12)


def test_histogram_values_on_edges(spark):
    for values, bins in (([0.0, 0.3, 0.6, 0.7, 1.0], 10), ([i / 7 for i in range(8)], 7), ([-0.1 * i for i in range(31)], 30)):
        df = spark.createDataFrame([(v,) for v in values], "r double")
        h = charts.histogram(df, "r", bins).orderBy("bin").toPandas()
        assert h["n"].tolist() == np.histogram(values, bins=bins)[0].tolist()


def test_bubble_size_floor_and_null(spark):
    df = spark.createDataFrame([(1, 100.0), (2, 1.0), (3, None)], "Store long, safety_stock double")
    rows = {r["Store"]: r["b"] for r in df.select("Store", charts.bubble_size().alias("b")).collect()}
    assert rows == {1: 400.0, 2: 30.0, 3: None}


def test_streaming_store_weekly_equals_batch(spark, sf_small, tmp_path):
    from demand_engine.operators.clean import build_store_weekly
    from demand_engine.sources import tables
    from demand_engine.streaming import store_weekly_stream

    li = spark.read.parquet(f"{sf_small}/lineitem.parquet")
    stream = spark.readStream.schema(li.schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf_small)
    stores = tables.load_stores(spark, sf_small)
    out = store_weekly_stream(tables.sales_from_lineitem(stream), stores, "3650 days")
    q = (out.writeStream.outputMode("update").format("memory").queryName("sw_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = spark.sql("SELECT * FROM sw_stream")
    batch = build_store_weekly(tables.sales_from_lineitem(li), stores)
    keys = ["Store", "Date", "IsHoliday", "Type", "Size"]
    a = got.select(*keys, F.round("Weekly_Sales", 2).alias("w")).orderBy(*keys).collect()
    b = batch.select(*keys, F.round("Weekly_Sales", 2).alias("w")).orderBy(*keys).collect()
    assert a == b


def test_entry_and_contract(spark):
    import __spark_entry__ as se

    df = se.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"Store", "safety_stock", "reorder_point", "eoq", "replenishment_alert"} <= set(df.columns)
    qs, sq = se.queries(), se.oracle_sql()
    assert set(sq) <= set(qs)
    assert len(qs) >= 60


@pytest.mark.parametrize("name", ["store_weekly", "prepare_features", "validation_tail_rows", "inventory_plan",
                                  "residual_histogram", "executive_summary"])
def test_oracle_matches_on_smallest_tables(spark, sf_small, name):
    import __spark_entry__ as se

    con = duckdb.connect()
    for t in ("lineitem", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    sdf = se.queries()[name](spark, sf_small)
    res = con.execute(se.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(sdf.columns)

    # Floats are compared with a tolerance: at an exact rounding tie the two
    # engines' summation order can move the last rounded digit.
    def sort_key(row):
        return tuple(str(v) if not isinstance(v, float) else "" for v in row)

    a = sorted((tuple(r[c] for c in cols) for r in sdf.collect()), key=sort_key)
    b = sorted((tuple(r) for r in res.fetchall()), key=sort_key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                assert u == pytest.approx(v, rel=1e-9, abs=2e-6)
            else:
                assert u == v


def test_ridge_on_store_week_rows(spark, sf_small):
    """Ridge on real training rows, where a feature (IsHoliday) is also a row key."""
    import __spark_entry__ as se

    df = se.queries()["forecast_ridge"](spark, sf_small)
    rows = df.collect()
    assert len(rows) > 0 and all(r["pred_Ridge_Regression"] >= 0 for r in rows)
