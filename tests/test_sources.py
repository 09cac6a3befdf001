import datetime as dt

import pytest

from demand_engine.operators.clean import build_store_weekly
from demand_engine.sources import load_raw_csv
from demand_engine.sources.tables import candidate_paths, read_sales_csv


def _write(tmp_path):
    (tmp_path / "train.csv").write_text(
        "Store,Date,Weekly_Sales,IsHoliday\n"
        "1,2010-02-05,100.5,FALSE\n"
        "1,2010-02-05,NaN,False\n"
        "1,2010-02-12,NA,TRUE\n"
        "1,2010-02-12,,true\n"
        "2,2010-02-05,-5.0,false\n"
        "2,2010-02-05,7.25,false\n"
    )
    (tmp_path / "stores.csv").write_text("Store,Type,Size\n1,A,151315\n2,B,202307\n")


def test_candidate_paths():
    assert candidate_paths("/x/data", "train.csv") == ["/x/data/train.csv", "/x/train.csv"]


def test_csv_fallback_to_parent_and_nan_is_null(spark, tmp_path):
    _write(tmp_path)
    sales, stores = load_raw_csv(spark, str(tmp_path / "data"))  # files live in the parent
    rows = sales.orderBy("Store", "Date").collect()
    assert len(rows) == 6
    values = [r["Weekly_Sales"] for r in rows]
    assert values.count(None) == 3  # NaN, NA and empty all become NULL
    assert rows[0]["Date"] == dt.date(2010, 2, 5) and rows[2]["IsHoliday"] is True
    sw = {(r["Store"], str(r["Date"])): r["Weekly_Sales"] for r in build_store_weekly(sales, stores).collect()}
    assert sw == {(1, "2010-02-05"): 100.5, (2, "2010-02-05"): 7.25}


def test_csv_columns_by_name(spark, tmp_path):
    (tmp_path / "train.csv").write_text("Dept,IsHoliday,Store,Weekly_Sales,Date\n4,FALSE,1,2.5,2010-02-05\n5,FALSE,1,1.5,2010-02-05\n")
    (tmp_path / "stores.csv").write_text("Size,Store,Type,Region\n10,1,A,x\n")
    sales, stores = load_raw_csv(spark, str(tmp_path))
    assert sales.columns == ["Store", "Date", "Weekly_Sales", "IsHoliday"]
    assert [r["Weekly_Sales"] for r in build_store_weekly(sales, stores).collect()] == [4.0]
    (tmp_path / "train.csv").write_text("Store,Date,IsHoliday\n1,2010-02-05,FALSE\n")
    with pytest.raises(ValueError, match="Weekly_Sales"):
        read_sales_csv(spark, str(tmp_path))


def test_csv_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_sales_csv(spark, str(tmp_path / "nowhere"))
