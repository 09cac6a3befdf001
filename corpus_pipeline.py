"""The corpus pipeline: each stage reads the documents that the stage before
it kept, applies one operator of ``demand_engine.llm`` and hands on Parquet.

The stages return the columns of ``documents``; the last one adds
``mix_repeats``, how often the mix takes a document (documents that it does
not take go). Empty tables pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demand_engine.llm import decontaminate, linededup, minhash, mixing, quality_rules
from demand_engine.llm.scratch import settled


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that fail or lose too much text."""
    return quality_rules.clean_documents(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines that an earlier document holds are cut out."""
    return linededup.dedup_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return minhash.dedup_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of ``benchmark`` go."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder. What
    a stage reads and writes on the way goes once its own rows are written."""

    def after(stages: int) -> DataFrame:
        if not stages:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        name, stage = STAGES[stages - 1]
        return settled(spark, lambda: stage(spark, after(stages - 1), sf_dir), name)

    return after(len(STAGES))


#: Minima of 64-bit hashes, components and thresholds have no short SQL form;
#: tests/llm holds each operator, and run() on planted documents, against
#: plain Python.
ORACLE_SQL: str | None = None
