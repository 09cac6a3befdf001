"""Benchmark decontamination by a prefix-filtered set join.

A needle is an item-sized window: ``window`` consecutive words of an item,
or the whole of a shorter item. A needle's tokens are its shingles. Tokens
are ordered by rarity over all documents; a document that contains a needle
in the wanted share holds at least one of the needle's rarest tokens (its
prefix), so documents are joined on prefix tokens only. Length and position
bounds drop candidates whose needle would stick out of the document, and
the words around each remaining candidate are compared in full.

Two passes read the documents: one counts the needles' shingles, one emits
the places of prefix tokens. A fixed-size bitmap of the wanted hashes goes
to the tasks; it only saves rows, the joins decide.

Cases: null or empty texts have no words and are not hit; null or empty
items have no needles; repeated rows are judged alike; equal items keep
their own ids; an empty table on either side gives clean documents or no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .scratch import materialise

#: Bits of the filter bitmap (4 MB): a fixed size, whatever the benchmark's.
BITMAP_BITS = 1 << 25
WINDOW = 13
SHINGLE = 5


def _words(batch: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the texts, one after another, and their offsets."""
    buf, off = tx.text_bytes(batch.column(text))
    buf = tx.LOWER[buf]
    starts, ends, at = tx.tokens(buf, off, tx.ALNUM)
    ids, words = tx.word_ids(buf, starts, ends)
    return tx.hash_words(words)[ids], at


def needles(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int, containment: float) -> DataFrame:
    """(item_id, words, token, place, size, n_tokens, need): a row per needle
    and shingle; ``need`` of the ``n_tokens`` shingles must be present."""
    src = items.select(items[id_col].alias("item_id"), items[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text", 1 << 20):
            hashes, at = _words(piece, "text")
            out: dict[str, list] = {x: [] for x in ("row", "words", "token", "place", "size", "n_tokens", "need")}
            for i in range(piece.num_rows):
                own = hashes[at[i] : at[i + 1]]
                width = min(window, len(own))
                for s in range(len(own) - width + 1 if width else 0):
                    w = own[s : s + width]
                    k = min(shingle, width)
                    t = tx.shingle_hashes(w, k)
                    need = int(np.ceil(containment * len(t) - 1e-9))
                    for name, x in zip(out, (i, w.astype("<u8").tobytes(), None, None, k, len(t), need), strict=True):
                        if x is not None:
                            out[name] += [x] * len(t)
                    out["token"] += t.view(np.int64).tolist()
                    out["place"] += range(len(t))
            ids = piece.column("item_id").take(pa.array(out["row"], pa.int64()))
            kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
            columns = [pa.array(out[x], kind) for x, kind in zip(list(out)[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["item_id", *list(out)[1:]])

    kind = src.schema["item_id"].dataType.simpleString()
    return src.mapInArrow(run, f"item_id {kind}, words binary, token long, place int, size int, n_tokens int, need int")


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of the hashes in ``column``, at most ``BITMAP_BITS`` of them.
    Bits are merged by Spark; a fixed number of words reaches the driver."""
    slot = F.pmod(F.col(column), F.lit(BITMAP_BITS))
    words = hashes.select((slot / 32).cast("int").alias("at"), F.expr(f"cast(1 as bigint) << cast(pmod({column}, {BITMAP_BITS}) % 32 as int)").alias("bit"))
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    for batch in words.groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow().to_batches():
        out[batch.column("at").to_numpy()] = batch.column("bits").to_numpy().astype(np.uint32)
    return out


def _in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(BITMAP_BITS - 1)
    return (bits[slot >> np.uint64(5)] >> (slot & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def _found(hashes: np.ndarray, at: np.ndarray, sizes: list[int], bits: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each shingle size: places whose token is in the bitmap, their
    tokens and their texts' numbers; no shingle crosses a text's end."""
    for k in sizes:
        tokens = tx.shingle_hashes(hashes, k)
        place = np.flatnonzero(_in_bitmap(bits, tokens))
        doc = np.searchsorted(at, place, "right") - 1
        inside = place + k <= at[doc + 1]
        yield k, place[inside], tokens[place[inside]], doc[inside]


def token_counts(docs: DataFrame, wanted: DataFrame, sizes: list[int], text_col: str) -> DataFrame:
    """(size, token, df): how often each wanted shingle occurs in all texts."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "token"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            hashes, at = _words(piece, "text")
            for k, _, tokens, _ in _found(hashes, at, sizes, bits.value):
                token, n = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(token), k, np.int32)), pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["size", "token", "n"])

    seen = docs.select(docs[text_col].alias("text")).mapInArrow(run, "size int, token long, n long")
    return seen.groupBy("size", "token").agg(F.sum("n").alias("df"))


def prefixes(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """Each needle's rarest n_tokens - need + 1 tokens. A needle is one item
    text window, so a group has as many rows as a window has shingles."""
    ranked = tokens.join(counts, ["size", "token"], "left").groupBy("item_id", "words", "size", "n_tokens", "need").agg(
        F.array_sort(F.collect_set(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token", "place"))).alias("order")
    )
    keep = F.slice("order", 1, F.col("n_tokens") - F.col("need") + 1)
    return ranked.select("item_id", "words", "size", "n_tokens", "need", F.explode(keep).alias("t")).select(
        "item_id", "words", "size", "n_tokens", "need", "t.token", "t.place"
    )


def candidates(docs: DataFrame, wanted: DataFrame, sizes: list[int], id_col: str, text_col: str, window: int) -> DataFrame:
    """Places of prefix tokens, with the words around: (row, n_words, at,
    size, token, left, words). Every document also gives one row with a null
    token, which carries its word count."""
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "token"))
    src = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "text_hash", "n_words", "at", "size", "token", "left", "words"]
        for piece in tx.pieces(batches, "text"):
            hashes, at = _words(piece, "text")
            n = np.diff(at)
            digest = piece.column("text_hash")
            m = piece.num_rows
            none = pa.nulls
            yield pa.RecordBatch.from_arrays([piece.column("id"), digest, pa.array(n.astype(np.int64)), none(m, pa.int64()), none(m, pa.int32()), none(m, pa.int64()), none(m, pa.int32()), none(m, pa.binary())], names)
            for k, place, tokens, doc in _found(hashes, at, sizes, bits.value):
                if not len(place):
                    continue
                lo = np.maximum(at[doc], place - (window - k))
                hi = np.minimum(at[doc + 1], place + window)
                around = [hashes[a:b].astype("<u8").tobytes() for a, b in zip(lo, hi, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").take(pa.array(doc)), digest.take(pa.array(doc)), pa.array(n[doc].astype(np.int64)), pa.array((place - at[doc]).astype(np.int64)),
                     pa.array(np.full(len(place), k, np.int32)), pa.array(tokens.view(np.int64)), pa.array((place - lo).astype(np.int32)), pa.array(around, pa.binary())], names,
                )

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, text_hash long, n_words long, at long, size int, token long, left int, words binary")


def needle_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str, window: int, shingle: int, containment: float) -> tuple[DataFrame, DataFrame]:
    """Documents (id, text_hash, n_words; a row per input row), and the
    verified places (id, text_hash, item_id, start, width)."""
    tokens = materialise(needles(items, item_id_col, item_text_col, window, shingle, containment), "needles")
    sizes = sorted(r["size"] for r in tokens.select("size").distinct().collect())  # at most SHINGLE values
    counts = materialise(token_counts(docs, tokens, sizes, text_col), "counts")
    prefix = materialise(prefixes(tokens, counts), "prefixes")
    places = materialise(candidates(docs, prefix, sizes, id_col, text_col, window), "places")
    near = places.where("token is not null").withColumnsRenamed({"words": "around", "size": "k", "token": "t"})
    start, width = F.col("left") - F.col("place"), F.length("words") / 8
    joined = near.join(prefix, (F.col("k") == F.col("size")) & (F.col("t") == F.col("token")))
    # position and length bounds: the needle must lie inside the document
    joined = joined.where((start >= 0) & (start + width <= F.length("around") / 8) & (F.col("n_words") >= width))
    there = F.substring("around", (start * 8 + 1).cast("int"), F.length("words"))
    joined = joined.select("id", "text_hash", "item_id", (F.col("at") - F.col("place")).alias("start"), width.cast("long").alias("width"), there.alias("there"), "words", "size", "need", "n_tokens")
    if containment < 1:
        joined = joined.where(shared_shingles("there", "words", "size") >= F.col("need"))
    else:
        joined = joined.where("there = words")
    hits = joined.select("id", "text_hash", "item_id", "start", "width").distinct()
    return places.where("token is null").select("id", "text_hash", "n_words"), hits


def shared_shingles(a: str, b: str, size: str) -> F.Column:
    """Distinct shingles of word hashes that two windows share."""

    def grams(x: str) -> F.Column:
        starts = F.sequence(F.lit(0), (F.length(x) / 8 - F.col(size)).cast("int"))
        return F.transform(starts, lambda i: F.substring(F.col(x), i * 8 + 1, F.col(size) * 8))

    return F.size(F.array_intersect(grams(a), grams(b)))


def judged_rows(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, shingle: int = SHINGLE, containment: float = 1.0, hit_share: float = 0.05,
) -> DataFrame:
    """One row per document: (id, text_hash), words, words inside an
    occurring window, the items found, their digest and the verdict."""
    rows, hits = needle_hits(docs, items, id_col, text_col, item_id_col, item_text_col, window, shingle, containment)
    # a document's places are no more than its words times the needle sizes
    per_doc = hits.groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("start", "width"))).alias("spans"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["start"] + s["width"] - F.greatest(acc["end"], s["start"]))).alias("n"), F.greatest(acc["end"], s["start"] + s["width"]).alias("end")
        ),
        lambda acc: acc["n"],
    )
    facts = per_doc.select(F.col("id").alias("its_id"), F.col("text_hash").alias("its_hash"), covered.alias("n_hit"), "items")
    out = rows.join(facts, F.col("id").eqNullSafe(F.col("its_id")) & (F.col("text_hash") == F.col("its_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    items_list = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "id", "text_hash", "n_words", n_hit.alias("n_hit"), F.size(items_list).cast("long").alias("n_items"), F.sha2(F.array_join(items_list, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit >= F.lit(hit_share) * F.col("n_words") - 1e-9)).alias("contaminated"),
    )


def contaminated_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``judged_rows`` by document id: n_words, n_hit, n_items,
    items_sha256 and contaminated (n_hit >= hit_share of the words)."""
    return judged_rows(docs, items, id_col, **options).withColumnRenamed("id", id_col).drop("text_hash")


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    bad = judged_rows(docs, items, id_col, text_col, **options).where("contaminated")
    bad = bad.select(F.col("id").alias("its_id"), F.col("text_hash").alias("its_hash")).distinct()
    packed = docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    same = packed["id"].eqNullSafe(bad["its_id"]) & (packed["text_hash"] == bad["its_hash"])
    return packed.join(bad, same, "left_anti").select(*(F.col("row")[c].alias(c) for c in docs.columns))
