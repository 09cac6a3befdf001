"""Readers for the two input tables: ``sales`` and ``stores``.

Two ways in:

* CSV files with the original layout (``read_sales_csv`` / ``read_stores_csv``),
  found in a data folder or its parent.
* The driver's parquet tables, mapped to the same logical schema
  (``sales_from_lineitem`` / ``stores_from_supplier``): suppliers play
  stores, line items are sales, returned lines become negative sales.

Every reader projects only the columns it needs, so the parquet scan's
``ReadSchema`` stays narrow, and turns NaN sales into NULL at the door.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.calendar import iso_week, week_start
from ..functions.nulls import nan_to_null
from . import schemas

# ---------------------------------------------------------------------------
# Fixed values of the driver-table mapping (our own rule, not the data's):
# ISO weeks flagged as holiday weeks, and the store-type letters chosen by
# nation key modulo 3.
# ---------------------------------------------------------------------------
HOLIDAY_ISO_WEEKS = (6, 36, 47, 52)
TYPE_LETTERS = "ABC"
SIZE_OFFSET = 20000
# ---------------------------------------------------------------------------


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def sales_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """lineitem -> sales(Store, Date, Weekly_Sales, IsHoliday)."""
    price = nan_to_null(F.col("l_extendedprice"))
    return lineitem.select(
        F.col("l_suppkey").cast("long").alias("Store"),
        week_start("l_shipdate").alias("Date"),
        F.when(F.col("l_returnflag") == "R", -price).otherwise(price).alias("Weekly_Sales"),
        iso_week("l_shipdate").isin(*HOLIDAY_ISO_WEEKS).alias("IsHoliday"),
    )


def stores_from_supplier(supplier: DataFrame) -> DataFrame:
    """supplier -> stores(Store, Type, Size)."""
    return supplier.select(
        F.col("s_suppkey").cast("long").alias("Store"),
        F.substr(F.lit(TYPE_LETTERS), F.pmod(F.col("s_nationkey"), F.lit(3)) + 1, F.lit(1)).alias("Type"),
        (F.floor(F.col("s_acctbal")).cast("int") + F.lit(SIZE_OFFSET)).cast("long").alias("Size"),
    )


def load_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_from_lineitem(read_table(spark, sf_dir, "lineitem"))


def load_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores_from_supplier(read_table(spark, sf_dir, "supplier"))


def load_raw_data(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(sales, stores) from the driver tables."""
    return load_sales(spark, sf_dir), load_stores(spark, sf_dir)


# ---------------------------------------------------------------------------
# CSV inputs with the original file names
# ---------------------------------------------------------------------------

def candidate_paths(data_dir: str, name: str) -> list[str]:
    """``data_dir/name`` first, then ``data_dir/../name``."""
    base = data_dir.rstrip("/")
    parent = base.rsplit("/", 1)[0] if "/" in base else "."
    return [f"{base}/{name}", f"{parent}/{name}"]


def _first_readable(spark: SparkSession, paths: Sequence[str], reader) -> DataFrame:
    for p in paths:
        try:
            return reader(p)
        except AnalysisException as exc:  # PATH_NOT_FOUND: try the next one
            if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
                raise
    raise FileNotFoundError(f"none of {list(paths)} exists")


def _read_by_name(spark: SparkSession, data_dir: str, name: str, schema: StructType) -> DataFrame:
    """The columns of ``schema`` from a CSV file, found by its header: other
    columns and any order are fine, an absent column is an error."""
    def reader(p: str) -> DataFrame:
        return spark.read.option("header", True).option("nullValue", "NA").csv(p)

    df = _first_readable(spark, candidate_paths(data_dir, name), reader)
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"{name} lacks columns {absent}; it has {df.columns}")
    return df.select(*[F.trim(F.col(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def read_sales_csv(spark: SparkSession, data_dir: str, name: str = "train.csv") -> DataFrame:
    df = _read_by_name(spark, data_dir, name, schemas.SALES)
    return df.withColumn("Weekly_Sales", nan_to_null("Weekly_Sales"))


def read_stores_csv(spark: SparkSession, data_dir: str, name: str = "stores.csv") -> DataFrame:
    return _read_by_name(spark, data_dir, name, schemas.STORES)


def load_raw_csv(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    return read_sales_csv(spark, data_dir), read_stores_csv(spark, data_dir)
