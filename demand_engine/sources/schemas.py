"""Explicit schemas of the logical tables."""

from pyspark.sql import types as T

SALES = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Weekly_Sales", T.DoubleType()),
    T.StructField("IsHoliday", T.BooleanType()),
])

STORES = T.StructType([
    T.StructField("Store", T.LongType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Size", T.LongType()),
])

STORE_WEEKLY_COLUMNS = ["Store", "Date", "IsHoliday", "Type", "Size", "Weekly_Sales"]

DEMAND_STATS_COLUMNS = ["Store", "avg_weekly_demand", "std_weekly_demand", "n_weeks", "cv"]
