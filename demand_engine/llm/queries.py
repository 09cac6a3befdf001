"""The numbered queries: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import classifier, decontaminate, html_extract, licenses, linededup, lm, minhash, mixing, phrases, quality_rules, search, suffixes, warc
from .oracle import ORACLE_SQL as ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line rules and base rules over every whole text of ``documents``."""
    return quality_rules.judge_documents(_table(spark, sf_dir, "documents"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all ``documents`` over 2-word shingles."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2, similarity=80)


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-bilinear class model over all ``documents``."""
    return lm.score_documents(_table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 50 bytes removed from all ``documents``."""
    return suffixes.remove_repeats(_table(spark, sf_dir, "documents"), depth=50)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` mixed by source to weights 5, 2, 1."""
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).drop("source", "repeats")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in all ``documents``."""
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written as WARC records and read back by the index."""
    index = warc.write_archives(_table(spark, sf_dir, "pages"))
    return warc.read_records(index, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbour votes of ``labels.quality`` for all ``documents``."""
    return classifier.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 13 words of ``benchmark`` in all ``documents``."""
    return decontaminate.contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks of all ``documents``, cut out."""
    return linededup.dedup_report(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two to five words in all ``documents``, by language."""
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best ``documents`` for each ``benchmark`` item."""
    return search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every row of ``pages``."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_quality_rules, op2_near_duplicates, op3_lm_scores, op4_suffix_dedup, op5_mix_sources, op6_license_scan, op7_warc, op8_quality_classifier, op9_decontaminate, op10_line_dedup, op11_phrases, op12_lexical_search, op13_html_extraction)}
