"""Collocations: phrases whose words occur together more often than their
parts would by chance, from sorted streams of counts.

Phrases are counted by order (number of words). The words are counted first;
each longer order only counts places whose shorter parts are frequent, since a
phrase is never more frequent than a part of it. A bitmap of fixed size tells
the tasks which parts are; it only saves rows, the exact counts decide.

The counts of all orders then form one stream, kept twice: in prefix order
(phrases sorted word by word) and in suffix order (sorted from the last word
back). In prefix order a phrase follows all its first parts, and the phrases
that extend it to the right follow it, so one pass in lockstep over the orders
gives the count of every first part (the last phrase of that order seen) and
whether an extension is as frequent as the phrase itself. The pass in suffix
order gives the same for last parts and extensions to the left. Nothing is
joined by a hash: the streams are dealt to buckets by range, so a word that
begins a third of all phrases is spread over many, and what a bucket's first
and last rows need from its neighbours is a few values for each bucket.

Cases: null or empty texts count nothing; a null language is ``und``; every
language is counted by itself; repeated rows count each time; equal scores
are ordered by count and then by phrase (bytes); an empty table gives no rows;
other columns are ignored. A text of many megabytes is counted in parts that
end with a piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import range_buckets
from . import textops as tx
from .decontaminate import _in_bitmap as in_bitmap
from .decontaminate import bitmap
from .scratch import materialise

LEAST = 100
LONGEST = 5
TOP = 2000
#: Groups by which a language's phrases are reduced before they meet.
MERGE_GROUPS = 64
#: Rows that a task sends at once; a piece of text may hold a million phrases.
BATCH_ROWS = 1 << 16

#: Bytes that end a piece: . , ; : ! ? and 0x0A to 0x0D.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
#: Bytes of words: all but those, space and tab.
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


def _tokens(words: np.ndarray, languages: np.ndarray) -> np.ndarray:
    """A hash for each row of word hashes, in its language."""
    h = languages.copy()
    for column in words.T:
        h = h * np.uint64(0x9E3779B97F4A7C15) + column
    return tx.mix(h)


def _places(order: int, joined: np.ndarray, words: np.ndarray, language: np.ndarray, part: int, bits: np.ndarray | None) -> np.ndarray:
    """First words of the phrases of ``order`` words that lie in one piece and
    whose parts of ``part`` words are all in the bitmap."""
    n = len(words) - order + 1
    if n <= 0:
        return np.empty(0, np.int64)
    inside = np.ones(n, bool)
    for i in range(order - 1):
        inside &= joined[i : n + i]
    if bits is not None:
        good = np.zeros(len(words), bool)
        whole = np.lib.stride_tricks.sliding_window_view(words, part)
        good[: len(whole)] = in_bitmap(bits, _tokens(whole, language[: len(whole)]))
        for i in range(order - part + 1):
            inside &= good[i : n + i]
    return np.flatnonzero(inside)


def counted(docs: DataFrame, orders: Sequence[int], part: int = 0, bits: np.ndarray | None = None) -> DataFrame:
    """(lang, phrase, c): exact counts of the phrases of ``orders`` words in
    ``docs`` (lang, text), words joined by a space. With order 1 the empty
    phrase counts all words."""
    known = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            coded = piece.column("lang").dictionary_encode()
            lang_hash = tx.hash_words(coded.dictionary.cast(pa.large_binary()))
            for buf, off in tx.parts(piece, "text", BREAK):
                buf = tx.lookup(tx.LOWER, buf)
                starts, ends, at = tx.tokens(buf, off, WORD)
                if not len(starts):
                    continue
                ids, words = tx.word_ids(buf, starts, ends)
                doc = np.searchsorted(at, np.arange(len(ids)), "right") - 1
                breaks = np.searchsorted(np.flatnonzero(tx.lookup(BREAK, buf)), starts)
                joined = (np.diff(breaks) == 0) & (np.diff(doc) == 0)
                code = coded.indices.to_numpy().astype(np.int64)[doc]
                del starts, ends, breaks, doc
                hashes = tx.hash_words(words)[ids] if known.value is not None else ids.astype(np.uint64)
                for order in orders:
                    place = _places(order, joined, hashes, lang_hash[code], part, known.value)
                    key = code[place]
                    for i in range(order):  # numbers of the distinct phrases so far
                        key = key * len(words) + ids[place + i]
                        if i < order - 1:
                            key = np.unique(key, return_inverse=True)[1]
                    _, first, n = np.unique(key, return_index=True, return_counts=True)
                    place = place[first]
                    del key, first
                    for j in range(0, len(place), BATCH_ROWS):
                        own = place[j : j + BATCH_ROWS]
                        text = [words.take(pa.array(ids[own + i])) for i in range(order)]
                        text = pc.binary_join_element_wise(*text, pa.scalar(b" ", pa.large_binary())) if order > 1 else text[0]
                        yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(code[own])), text.cast(pa.string()), pa.array(n[j : j + BATCH_ROWS].astype(np.int64))], ["lang", "phrase", "n"])
                if 1 in orders:
                    total = np.bincount(code)
                    own = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(own)), pa.array([""] * len(own)), pa.array(total[own].astype(np.int64))], ["lang", "phrase", "n"])

    return docs.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("c"))


def _bits_of(frequent: DataFrame, order: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = batch.column("lang").dictionary_encode()
            if not batch.num_rows:
                continue
            language = tx.hash_words(coded.dictionary.cast(pa.large_binary()))[coded.indices.to_numpy()]
            words = tx.hash_words(pc.split_pattern(batch.column("phrase"), " ").flatten().cast(pa.large_binary()))
            yield pa.RecordBatch.from_arrays([pa.array(_tokens(words.reshape(-1, order), language).view(np.int64))], ["token"])

    return bitmap(frequent.select("lang", "phrase").mapInArrow(run, "token long"), "token")


def streams(docs: DataFrame, least: int, longest: int) -> tuple[DataFrame, DataFrame]:
    """The counts of all phrases of up to ``longest`` words that occur
    ``least`` times: (lang, phrase, c, words); and (lang, n), all words."""
    every = materialise(counted(docs, [1]).where((F.col("c") >= least) | (F.col("phrase") == "")), "words")
    totals = every.where("phrase = ''").select("lang", F.col("c").alias("n"))
    found = [every.where("phrase <> ''")]
    for orders, part in (([2], 1), ([3], 2), (list(range(4, longest + 1)), 3)):
        orders = [x for x in orders if x <= longest]
        if orders:
            found.append(materialise(counted(docs, orders, part, _bits_of(found[-1], part)).where(F.col("c") >= least), "phrases"))
    stream = found[0]
    for more in found[1:]:
        stream = stream.union(more)
    return stream.withColumn("words", F.split("phrase", " ")), totals


def scan(stream: DataFrame, key: Column, longest: int, counts: str, absorbed: str) -> DataFrame:
    """``stream`` in the order of ``key`` (the words, or the words reversed),
    with two columns more. ``counts``: how often the first 1, 2, ... words of
    the key occur. ``absorbed``: whether a key of one word more that begins
    with this one is as frequent."""
    ranged = range_buckets(stream.withColumn("_key", key).withColumn("_size", F.size("words")), ["lang", "_key"])
    forth = Window.partitionBy("_bucket").orderBy("lang", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("_bucket").orderBy(F.desc("lang"), F.desc("_key")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = range(1, longest)

    # a bucket may begin amid the phrases that share first words: their counts
    # come from an earlier bucket, by the bucket's first key (a row a bucket)
    heads = ranged.groupBy("_bucket").agg(F.min(F.struct("lang", "_key")).alias("h")).select("_bucket", "h.lang", "h._key")
    heads = heads.select("_bucket", "lang", F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(longest - 1)), lambda k: F.slice("_key", 1, k))).alias("k", "_key"))
    heads = ranged.select("lang", "_key", "c").join(F.broadcast(heads), ["lang", "_key"]).groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("k", "c"))).alias("_head"))
    rows = ranged.join(F.broadcast(heads), "_bucket", "left")
    seen = [F.coalesce(F.last(F.when(F.col("_size") == k, F.col("c")), ignorenulls=True).over(forth), F.try_element_at("_head", F.lit(k - 1))) for k in sizes]
    rows = rows.withColumns({f"_f{k}": x for k, x in zip(sizes, seen, strict=True)})

    # read backwards: the phrases that extend one lie behind it, up to the next of its size or less
    parent = F.coalesce(*(F.when(F.col("_size") == k + 1, F.col(f"_f{k}")) for k in sizes), F.lit(0))
    says = {k: F.when(F.col("_size") <= k, False).when((F.col("_size") == k + 1) & (F.col("c") == parent), True) for k in sizes}
    rows = rows.withColumns({f"_s{k}": x for k, x in says.items()})
    rows = rows.withColumns({f"_b{k}": F.last(f"_s{k}", ignorenulls=True).over(back) for k in sizes})
    # what the first rows of later buckets say (a row a bucket)
    first = rows.groupBy("_bucket").agg(*(F.min_by(F.when(F.col(f"_s{k}").isNotNull(), F.col(f"_s{k}")), F.when(F.col(f"_s{k}").isNotNull(), F.struct("lang", "_key"))).alias(f"_s{k}") for k in sizes))
    later = Window.orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    after = first.select("_bucket", *(F.last(f"_s{k}", ignorenulls=True).over(later).alias(f"_a{k}") for k in sizes))
    rows = rows.join(F.broadcast(after), "_bucket", "left")
    taken = F.coalesce(*(F.when(F.col("_size") == k, F.coalesce(f"_b{k}", f"_a{k}")) for k in sizes), F.lit(False))
    return rows.select(*stream.columns, F.array(*(f"_f{k}" for k in sizes)).alias(counts), taken.alias(absorbed))


def scored(rows: DataFrame, totals: DataFrame, longest: int) -> DataFrame:
    """(lang, phrase, a, l, r, n, score): the phrases of two words or more
    by their lowest cut. Products are decimals of 38 digits."""
    big = lambda c: F.col(c).cast("decimal(19,0)")
    rows = rows.where(F.size("words") > 1).join(totals, "lang").withColumn("_an", big("c") * big("n") * F.lit(1000).cast("decimal(4,0)"))
    cuts = []
    for k in range(1, longest):
        left, right = F.col("first_counts")[k - 1], F.try_element_at("last_counts", F.size("words") - k)
        cut = F.struct(F.call_function("div", F.col("_an"), left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))
        cuts.append(F.when(F.size("words") > k, cut))
    low = F.array_min(F.array(*cuts))
    return rows.withColumn("cut", low).select("lang", "phrase", F.col("c").alias("a"), "cut.l", "cut.r", "n", "cut.score", "absorbed_right", "absorbed_left")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP, missing: str = "und") -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    src = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(missing)).alias("lang"), docs[text_col].alias("text"))
    stream, totals = streams(src, least, longest)
    forth = scan(stream, F.col("words"), longest, "first_counts", "absorbed_right")
    both = scan(forth, F.reverse("words"), longest, "last_counts", "absorbed_left")
    rows = scored(both, totals, longest).where("not absorbed_right and not absorbed_left")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = rows.withColumn("_g", F.pmod(F.xxhash64("phrase"), F.lit(MERGE_GROUPS)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_g").orderBy(*order))).where(F.col("_r") <= top)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return last.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
