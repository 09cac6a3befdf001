"""Baseline forecasters: last value and moving average.

Protocol shared by every forecaster:

    model = Forecaster(...).fit(train_df)      # may run Spark jobs
    scored = model.predict(df)                 # lazy; appends ``model.output_col``
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import MOVING_AVERAGE_WINDOW, NAIVE_NAME, moving_average_name
from ..functions.formatting import prediction_column_name
from ..functions.nulls import fill_zero

ROW_ORDER = ("Date", "IsHoliday", "Type", "Size")


def naive_last(train: DataFrame, group_col: str = "Store", target: str = "Weekly_Sales",
               order_cols: tuple[str, ...] = ROW_ORDER) -> DataFrame:
    """Last non-missing target per group, in (date, ...) order: (group, last_value).

    The order columns are packed into one decimal of 36 digits (day, flag, the
    type's first seven bytes, size; missing ones first), so the plan is a hash
    aggregate with map-side combine.
    """
    have = set(order_cols) & set(train.columns)
    day = F.datediff(F.col(order_cols[0]), F.lit("1970-01-01").cast("date")).cast("long")
    flag = F.coalesce(F.col("IsHoliday").cast("long"), F.lit(-1)) + 1 if "IsHoliday" in have else F.lit(0)
    head = F.conv(F.rpad(F.hex(F.substring(F.encode("Type", "UTF-8"), 1, 7)), 14, "0"), 16, 10).cast("decimal(17,0)") if "Type" in have else F.lit(None)
    letters = F.coalesce(head + 1, F.lit(0)).cast("decimal(18,0)")
    size = F.coalesce(F.col("Size").cast("long"), F.lit(0)) if "Size" in have else F.lit(0)
    order = ((day * 4 + flag).cast("decimal(8,0)") * F.lit(10**17).cast("decimal(18,0)") + letters) * F.lit(10**12).cast("decimal(13,0)") + size.cast("decimal(13,0)")
    return (
        train.filter(F.col(target).isNotNull() & ~F.isnan(target))
        .groupBy(group_col)
        .agg(F.max_by(target, order).alias("last_value"))
    )


@dataclass
class NaiveModel:
    last: DataFrame
    group_col: str = "Store"
    name: str = NAIVE_NAME

    @property
    def output_col(self) -> str:
        return prediction_column_name(self.name)

    def predict(self, df: DataFrame) -> DataFrame:
        """Look up the last value per group; unknown groups get 0.

        The lookup table has one row per store; the join strategy is left to
        the optimizer and AQE (broadcast only when measured small).
        """
        last = self.last.withColumnRenamed("last_value", "_last_value")
        return df.join(last, self.group_col, "left") \
            .withColumn(self.output_col, fill_zero("_last_value")).drop("_last_value")


class NaiveForecaster:
    name = NAIVE_NAME

    def __init__(self, group_col: str = "Store", target: str = "Weekly_Sales"):
        self.group_col = group_col
        self.target = target

    def fit(self, train: DataFrame) -> NaiveModel:
        return NaiveModel(naive_last(train, self.group_col, self.target), self.group_col, self.name)


@dataclass
class MovingAverageModel:
    window: int
    name: str

    @property
    def output_col(self) -> str:
        return prediction_column_name(self.name)

    def predict(self, df: DataFrame) -> DataFrame:
        col = f"sales_roll_{self.window}"
        if col not in df.columns:
            raise ValueError(f"feature '{col}' missing: run add_lag_features with window {self.window} first")
        return df.withColumn(self.output_col, fill_zero(col))


class MovingAverageForecaster:
    """Predicts the trailing mean of the previous ``window`` rows (a feature column)."""

    def __init__(self, window: int = MOVING_AVERAGE_WINDOW):
        self.window = window
        self.name = moving_average_name(window)

    def fit(self, train: DataFrame | None = None) -> MovingAverageModel:
        return MovingAverageModel(self.window, self.name)
