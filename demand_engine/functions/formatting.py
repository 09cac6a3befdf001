"""Names and text formats used in outputs and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import col_


def prediction_column_name(model_name: str) -> str:
    """'Moving Average (4w)' -> 'pred_Moving_Average_4w'."""
    cleaned = model_name.replace(" ", "_").replace("(", "").replace(")", "").replace("/", "_")
    return f"pred_{cleaned}"


def prediction_column_expr(model_name: str | Column) -> Column:
    """Same rule applied to a column of model names."""
    x = F.translate(col_(model_name), "()", "")
    return F.concat(F.lit("pred_"), F.translate(x, " /", "__"))


def money(c: str | Column) -> Column:
    """'$1,234,567' (no decimals)."""
    return F.concat(F.lit("$"), F.format_number(F.round(col_(c)), 0))


def percent(c: str | Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", col_(c)), F.lit("%"))
