"""Small plan helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row frame (e.g. a global aggregate) to every row.

    A global aggregate always yields exactly one row, so broadcasting it is
    safe at any scale; the join keeps ``df``'s partitioning. Used instead of
    a scalar subquery when the value is referenced several times.
    """
    return df.crossJoin(F.broadcast(one_row))
