"""Plan-shape guards for the properties the design relies on at scale."""

import contextlib
import io

from demand_engine.operators.clean import build_store_weekly
from demand_engine.operators.features import prepare_features
from demand_engine.sources import load_raw_data


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_raw_rows_are_not_shuffled(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    lines = _physical(build_store_weekly(sales, stores)).splitlines()
    exchanges = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert exchanges
    for i in exchanges:  # every hash exchange sits on top of a partial aggregate
        assert "partial_" in lines[i + 1], lines[i + 1]


def test_scan_reads_only_needed_columns(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    text = _formatted(build_store_weekly(sales, stores))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_returnflag:string,l_shipdate:timestamp_ntz>" in text


def test_lazy_features_read_the_fact_table_at_most_twice(spark, sf_small):
    sales, stores = load_raw_data(spark, sf_small)
    plan = _physical(prepare_features(build_store_weekly(sales, stores)))
    scans = [line for line in plan.splitlines() if "Scan parquet" in line and "lineitem" in line]
    assert 1 <= len(scans) <= 2


def test_intermediate_tables_are_pruned_and_filtered(spark, sf_small):
    from pyspark.sql import functions as F

    from demand_engine.operators.inventory import compute_demand_stats
    from demand_engine.operators.split import cutoff_info, train_rows
    from demand_engine.session import materialize

    sales, stores = load_raw_data(spark, sf_small)
    weekly = materialize(build_store_weekly(sales, stores))
    features = materialize(prepare_features(weekly))
    cut = F.lit(cutoff_info(weekly).first()["cutoff_date"])
    text = _formatted(train_rows(features, cut).select("Store", "Date", "Weekly_Sales"))
    assert "ReadSchema: struct<Store:bigint,Date:date,Weekly_Sales:double>" in text
    assert "LessThan(Date" in text
    assert "ReadSchema: struct<Date:date>" in _formatted(cutoff_info(weekly))
    assert "ReadSchema: struct<Store:bigint,Weekly_Sales:double>" in _formatted(compute_demand_stats(features))


def test_naive_last_is_a_hash_aggregate(spark, sf_small):
    from demand_engine.operators.baselines import naive_last

    sales, stores = load_raw_data(spark, sf_small)
    plan = _physical(naive_last(build_store_weekly(sales, stores)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_reports_do_not_scan_the_fact_table_again(spark, sf_small):
    import __spark_entry__ as se

    for name in ("executive_summary", "report_text"):
        assert "lineitem" not in _physical(se.queries()[name](spark, sf_small))


def test_no_shared_folder_is_an_error_off_a_local_master():
    import types

    import pytest

    from demand_engine import session

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = types.SimpleNamespace(get=lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
