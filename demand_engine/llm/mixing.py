"""Mixing sources to target weights by hash thresholds.

Every document has a 64-bit hash. Per source, sizes are summed by the first
16 bits of the hash; the running sum names the bucket in which the source's
budget ends, and only that bucket's documents are summed by the next 16
bits, and so on to the whole hash. A document is taken when its hash lies
below its source's threshold, so nothing is sorted, a smaller budget takes
a subset of a larger one's documents, and reruns agree.

A target above a source's size takes all its documents whole times, and the
rest of the target by the threshold.

Cases: a null or empty text has size 0 and takes 0 words; null is a source
of its own, ranked last; equal rows (same id and text) have one hash and
are taken alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import textops as tx
from .scratch import materialise

SALTS = 32
_LEVELS = (48, 32, 16, 0)


def _hash(id_col: Column, text_col: Column) -> Column:
    return F.xxhash64(id_col, text_col)


def document_sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, h, size): the words of each whole text, counted once."""
    src = docs.select(docs[id_col].alias("id"), docs[source_col].alias("source"), _hash(docs[id_col], docs[text_col]).alias("h"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            buf, off = tx.text_bytes(piece.column("text"))
            size = np.diff(tx.tokens(buf, off, tx.SPACED)[2]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*(piece.column(x) for x in ("id", "source", "h")), pa.array(size)], ["id", "source", "h", "size"])

    types = src.schema
    return src.mapInArrow(run, f"id {types['id'].dataType.simpleString()}, source {types['source'].dataType.simpleString()}, h long, size long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """(source, source_size, n) with n from 0 by code point, null last. The
    order is made by range partitions and their counts, not in one task."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    parts = materialise(
        totals.repartitionByRange(F.col("source").isNull(), F.col("source")).withColumn("part", F.spark_partition_id()), "sources"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return parts.join(offsets, "part").select("source", "source_size", (F.row_number().over(inside) - 1 + F.col("skip")).alias("n"))


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeats: int) -> DataFrame:
    """(source, source_size, target): shares of all sizes by weight; targets
    stop at ``max_repeats`` times the size and the excess is shared again by
    weight among the others until none is above."""
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.pmod(F.col("n"), F.lit(len(weights))) + 1).cast("int"))
    sources = materialise(ranked_sources(sizes).withColumn("weight", weight), "targets")
    cap = F.col("source_size") * max_repeats
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > cap
        got = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(above, cap)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("weight"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if got["weight"] is None or got["n"] == capped:
            break
        capped, level = got["n"], ((got["all"] or 0) - (got["full"] or 0)) / got["weight"]
    target = F.least(F.col("weight") * F.lit(level), cap.cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def _salted(per_source: DataFrame) -> DataFrame:
    return per_source.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Rows joined to their source's values; each source's rows are spread
    over salts, so one source may hold most of them."""
    small = _salted(per_source).withColumnsRenamed({"source": "its_source", "salt": "its_salt"})
    on = F.col("source").eqNullSafe(F.col("its_source")) & (F.pmod(F.col("h"), F.lit(SALTS)).cast("int") == F.col("its_salt"))
    return rows.join(small, on).drop("its_source", "its_salt")


def source_thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, times, threshold, inclusive): every
    document is taken ``times`` times, and once more when its hash is below
    the threshold (or equal, where inclusive)."""
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    state = targets.withColumn("times", times).withColumn("rest", F.col("target") - F.col("times") * F.col("source_size"))
    state = materialise(state.withColumn("prefix", F.lit(0).cast("long")).withColumn("below", F.lit(0.0)), "thresholds")
    keys = ["source", "source_size", "target", "times", "rest"]
    for level, shift in enumerate(_LEVELS):
        rows = _with_source(sizes, state)
        if level:
            rows = rows.where(F.shiftright("h", _LEVELS[level - 1]) == F.col("prefix"))
        bucket = rows.withColumn("bucket", F.shiftright("h", shift)).groupBy(*keys, "below", "bucket").agg(F.sum("size").alias("sum"))
        upto = F.col("below") + F.sum("sum").over(Window.partitionBy("source").orderBy("bucket"))
        end = bucket.withColumn("upto", upto).where(F.col("upto") > F.col("rest"))
        # the first bucket that goes beyond the rest; a source whose documents end before has none
        first = end.groupBy(*keys).agg(F.min_by(F.struct("bucket", "sum", "upto"), "bucket").alias("b"))
        state = materialise(
            first.select(*keys, F.col("b.bucket").alias("prefix"), (F.col("b.upto") - F.col("b.sum")).alias("below"), F.col("b.sum").alias("sum")),
            "thresholds",
        )
    found = state.select("source", F.col("prefix").alias("threshold"), ((F.col("rest") - F.col("below")) * 2 > F.col("sum")).alias("inclusive"))
    base = targets.withColumn("times", times)
    other = found.withColumnRenamed("source", "its_source")
    joined = base.join(other, base["source"].eqNullSafe(other["its_source"]), "left").drop("its_source")
    return joined


def _repeats() -> Column:
    once_more = (F.col("h") < F.col("threshold")) | (F.col("inclusive") & (F.col("h") == F.col("threshold")))
    return F.col("times") + F.coalesce(once_more, F.lit(False)).cast("int")


def _plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float], max_repeats: int) -> tuple[DataFrame, DataFrame]:
    sizes = materialise(document_sizes(docs, id_col, text_col, source_col), "sizes")
    return sizes, materialise(source_thresholds(sizes, source_targets(sizes, weights, max_repeats)), "mix")


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5, 2, 1), max_repeats: int = 3
) -> DataFrame:
    """One row per document: its size, its source's size and target, how
    often it is taken, and the words that makes."""
    sizes, plan = _plan(docs, id_col, text_col, source_col, weights, max_repeats)
    rows = _with_source(sizes, plan).withColumn("repeats", _repeats())
    return rows.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[float] = (5, 2, 1), max_repeats: int = 3
) -> DataFrame:
    """The documents that the mix takes, with ``mix_repeats`` (which takes
    the place of a column of that name)."""
    _, plan = _plan(docs, id_col, text_col, source_col, weights, max_repeats)
    packed = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[source_col].alias("source"), _hash(docs[id_col], docs[text_col]).alias("h"))
    rows = _with_source(packed, plan).withColumn("repeats", _repeats()).where("repeats > 0")
    names = [c for c in docs.columns if c != "mix_repeats"]
    return rows.select(*(F.col("row")[c].alias(c) for c in names), F.col("repeats").alias("mix_repeats"))
