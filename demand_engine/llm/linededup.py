"""Line dedup by chunks of two neighbouring lines.

Lines that hold a word are numbered, and every two that follow each other
make a chunk (blank lines between them included), so chunks overlap and no
boundary can fall badly: a passage of n lines that repeats holds n - 1
chunks that do, whatever stands around it. A rolling hash over the two line
hashes is the chunk's key; chunks are counted by it over all documents, and
where it repeats, their bytes are compared. Every line that lies in a chunk
with an equal one before it (smallest id, then position) is cut out of its
document. A single line that repeats stays.

Cases: null or empty texts have no chunks and stay; a null id comes last
among keepers; rows with equal id and text are one document written twice
and are cut alike; within one document later equal chunks go too, unless
they share a line with the first; an empty table gives no rows; extra
columns are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .scratch import materialise, shuffles_dropped

MIN_LINES = 2


def chunk_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, line number) of the lines that hold a word."""
    out, at = [], 0
    for n, line in enumerate(text.split(b"\n")):
        if line.strip():
            out.append((at, at + len(line), n))
        at += len(line) + 1
    return out


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    return [docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("th")]


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, idx, start, second, end, lines, h): a row per two neighbouring
    lines; ``second`` is where the other line starts, ``lines`` how many
    there are before it."""
    src = docs.select(*_row_key(docs, id_col, text_col), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            buf, off = tx.text_bytes(piece.column("text"))
            raw = buf.tobytes()
            spans, hashes, count = [], [], np.zeros(piece.num_rows, np.int64)
            for i in range(piece.num_rows):
                text = raw[off[i] : off[i + 1]]
                own = chunk_spans(text)
                if len(own) >= MIN_LINES:
                    spans += own
                    hashes += [xxhash.xxh3_64_intdigest(text[a:b]) for a, b, _ in own]
                    count[i] = len(own)
            at = np.array(spans, np.int64).reshape(-1, 3)
            line = np.array(hashes, np.uint64)
            row = np.repeat(np.arange(len(count)), count)
            idx = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            k = np.flatnonzero(row[1:] == row[:-1])
            h = tx.mix(line[k] * np.uint64(0x9E3779B97F4A7C15) + line[k + 1])
            keys = [piece.column(c).take(pa.array(row[k])) for c in ("id", "th")]
            rest = [pa.array(idx[k], pa.int32()), *(pa.array(x) for x in (at[k, 0], at[k + 1, 0], at[k + 1, 1])), pa.array(at[k + 1, 2] - at[k, 2], pa.int32()), pa.array(h.view(np.int64))]
            yield pa.RecordBatch.from_arrays([*keys, *rest], ["id", "th", "idx", "start", "second", "end", "lines", "h"])

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, th long, idx int, start long, second long, end long, lines int, h long")


def _same_row(left: DataFrame, right: DataFrame, id_name: str = "id") -> Column:
    return left[id_name].eqNullSafe(right["its_id"]) & (left["th"] == right["its_th"])


def _place() -> Column:
    """Orders chunk places: null ids last."""
    return F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "idx")


def repeated_chunks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All chunks, and (its_id, its_th, cuts): the lines to cut from each
    document that has any, in order."""
    found = materialise(chunks(docs, id_col, text_col), "chunks")
    places = found.select("id", "th", "idx", "h").distinct()  # equal rows count once
    often = places.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    wanted = found.join(often, "h").groupBy("id", "th").agg(F.collect_set(F.struct("idx", "start", "second", "end", "lines", "h")).alias("spans"))
    wanted = wanted.withColumnsRenamed({"id": "its_id", "th": "its_th"})
    texts = docs.select(*_row_key(docs, id_col, text_col), docs[text_col].cast("binary").alias("bytes"))
    named = texts.join(wanted, _same_row(texts, wanted)).select("id", "th", "bytes", F.explode("spans").alias("s"))
    body = F.substring("bytes", (F.col("s.start") + 1).cast("int"), (F.col("s.end") - F.col("s.start")).cast("int"))
    with shuffles_dropped(docs.sparkSession):  # all texts, which are dealt again for the cut
        rows = materialise(named.select("id", "th", "s.*", body.alias("body")), "repeats")
    first = rows.groupBy("h", "body").agg(F.min(_place()).alias("first"))
    elsewhere = ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("th") == F.col("first.th")))
    later = rows.join(first, ["h", "body"]).where(elsewhere | (F.col("idx") >= F.col("first.idx") + MIN_LINES))
    # the first line with the blank ones after it, and the second
    parts = F.array(F.struct("start", (F.col("second") - 1).alias("end"), "lines"), F.struct(F.col("second").alias("start"), "end", F.lit(1).alias("lines")))
    gone = later.select("id", "th", F.explode(parts).alias("s")).groupBy("id", "th", "s.start").agg(F.max("s.end").alias("end"), F.max("s.lines").alias("lines"))
    cuts = gone.groupBy("id", "th").agg(F.array_sort(F.collect_list(F.struct("start", "end", "lines"))).alias("cuts"))
    return found, cuts.withColumnsRenamed({"id": "its_id", "th": "its_th"})


def cut_text(text: Column, cuts: Column) -> Column:
    """The text without the spans and without the newline after each."""
    data = text.cast("binary")
    stops = F.concat(F.transform(cuts, lambda s: s["start"]), F.array(F.length(data).cast("long")))
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(cuts, lambda s: s["end"] + 1))
    parts = F.zip_with(begins, stops, lambda a, b: F.substring(data, (a + 1).cast("int"), F.greatest(b - a, F.lit(0)).cast("int")).cast("string"))
    return F.when(cuts.isNull() | (F.size(cuts) == 0), text).otherwise(F.array_join(parts, ""))


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its bytes, what was cut (``n_removed_chunks`` are
    runs of lines), and a digest of the rest."""
    _, cuts = repeated_chunks(docs, id_col, text_col)
    rows = docs.select(*_row_key(docs, id_col, text_col), docs[text_col].alias("text"))
    kept = F.coalesce(cut_text(F.col("text"), F.col("cuts")), F.lit(""))
    spans = F.coalesce(F.col("cuts"), F.array().cast("array<struct<start:bigint,end:bigint,lines:int>>"))
    out = rows.join(cuts, _same_row(rows, cuts), "left").select("id", "text", spans.alias("cuts"), kept.alias("kept"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    runs = F.size(F.array_except(F.col("cuts")["start"], F.transform("cuts", lambda s: s["end"] + 1))).cast("long")
    return out.select(
        F.col("id").alias(id_col), n_bytes.alias("n_bytes"), runs.alias("n_removed_chunks"),
        F.aggregate("cuts", F.lit(0).cast("long"), lambda n, s: n + s["lines"]).alias("n_removed_lines"),
        (n_bytes - F.octet_length("kept")).alias("n_removed_bytes"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated chunks cut out. Those of which no word
    is left by the cut go; ``n_chars``, where present, follows the text."""
    _, cuts = repeated_chunks(docs, id_col, text_col)
    packed = docs.select(*_row_key(docs, id_col, text_col), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    joined = packed.join(cuts, _same_row(packed, cuts), "left")
    cut = joined.withColumn("kept", cut_text(F.col("row")[text_col], F.col("cuts")))
    cut = cut.where(F.col("cuts").isNull() | F.col("kept").rlike(r"[^\x20\x09-\x0D]"))
    columns = []
    for field in docs.schema:
        if field.name == text_col:
            columns.append(F.col("kept").alias(field.name))
        elif field.name == "n_chars":
            now = F.when(F.col("cuts").isNull(), F.col("row.n_chars")).otherwise(F.length("kept").cast(field.dataType))
            columns.append(now.alias(field.name))
        else:
            columns.append(F.col("row")[field.name].alias(field.name))
    return cut.select(*columns)
