"""Writers. Spark writes part files in parallel and creates the folders."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
) -> str:
    """Write ``df`` as parquet (default) or CSV with a header.

    ``sort_by`` sorts within each output partition only (no global sort),
    which keeps the write parallel while giving readable files.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        w.format(fmt).save(path)
    return path


def write_text(lines: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a one-column string DataFrame as a single text file.

    Only for small, bounded outputs such as the summary report.
    """
    lines.coalesce(1).write.mode(mode).text(path)
    return path
