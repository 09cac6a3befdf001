"""Ranked lexical search: every item of a query table against all documents,
by presence masks.

Documents are read once and cut into blocks (pieces of text); of each block
the places and counts of the query terms are kept, packed by term. A block
meets the queries in blocks of items. There, bitmap operations give every
document a mask of the item's terms that it holds; documents with equal masks
form a group. A mask's highest possible score is the sum of its terms'
highest contributions in the block, so masks are worked off from the highest
bound down, and the rest of the block is left once the k-th best score found
lies above the next bound. The best k of each block and item meet in two
levels.

Scores are integers: a term's weight is floor(1000 * ln((2N + 2) / (2df + 1)));
its contribution is weight * ((10**9 * tf) div (1000 * tf + 8 * m)) with
m = 10 + (90 * n * N) div L.

Cases: null or empty texts hold no term and are no hit; null or empty items
find nothing; rows that share an item id are one item with all their terms;
each document row is a hit of its own, also where ids repeat; equal scores
are ordered by ascending id, null ids last; an empty table on either side
gives no rows; other columns are ignored; long texts are counted in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as tx
from .decontaminate import _in_bitmap as in_bitmap
from .decontaminate import bitmap
from .scratch import materialise

TOP = 10
#: Term rows of the items that meet a block of documents in one task.
ITEM_ROWS = 50_000
#: Documents of several masks that are evaluated at once.
TOGETHER = 128
#: Groups by which an item's hits of all blocks are reduced before they meet.
MERGE_GROUPS = 64


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, token): the distinct terms of each item, with hashes."""
    src = items.select(items[id_col].alias("item_id"), items[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            for buf, off in tx.parts(piece, "text", ~tx.ALNUM & ~tx.ALNUM[tx.LOWER]):
                buf = tx.LOWER[buf]
                starts, ends, at = tx.tokens(buf, off, tx.ALNUM)
                ids, words = tx.word_ids(buf, starts, ends)
                row = np.searchsorted(at, np.arange(len(ids)), "right") - 1
                pair = np.unique(row * max(1, len(words)) + ids)
                row, word = np.divmod(pair, max(1, len(words)))
                token = tx.hash_words(words)[word].view(np.int64)
                yield pa.RecordBatch.from_arrays([piece.column("item_id").take(pa.array(row)), words.take(pa.array(word)).cast(pa.string()), pa.array(token)], ["item_id", "term", "token"])

    kind = src.schema["item_id"].dataType.simpleString()
    return src.mapInArrow(run, f"item_id {kind}, term string, token long").dropDuplicates(["item_id", "term"])


def postings(docs: DataFrame, bits: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """Blocks of documents: (block, term, at, tf, ids, sizes, n_docs, n_terms).

    A block has a row for each term that the bitmap lets through, with the
    numbers of the documents that hold it and their counts, and one row with
    a null term: ids and sizes of its documents, how many have a term and all
    their terms. Block numbers hold for one run of a task, so the table must
    be written before it is read twice."""
    wanted = docs.sparkSession.sparkContext.broadcast(bits)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for piece in tx.pieces(batches, "text"):
            n, found = np.zeros(piece.num_rows, np.int64), []
            for buf, off in tx.parts(piece, "text", ~tx.ALNUM & ~tx.ALNUM[tx.LOWER]):
                buf = tx.LOWER[buf]
                starts, ends, at = tx.tokens(buf, off, tx.ALNUM)
                n += np.diff(at)
                ids, words = tx.word_ids(buf, starts, ends)
                keep = in_bitmap(wanted.value, tx.hash_words(words))
                place = np.flatnonzero(keep[ids])
                doc = np.searchsorted(at, place, "right") - 1
                pair, tf = np.unique(ids[place] * piece.num_rows + doc, return_counts=True)
                word, doc = np.divmod(pair, piece.num_rows)
                first = np.flatnonzero(np.diff(word, prepend=-1))
                terms = words.take(pa.array(word[first])).cast(pa.string()).to_pylist()
                for t, d, c in zip(terms, np.split(doc, first[1:]), np.split(tf, first[1:]), strict=False):
                    found.append((t, d.astype("<u4"), c.astype("<i8")))
            if len(found) > 1 and piece.num_rows == 1:  # the parts of one long text
                total: dict[str, int] = {}
                for t, _, c in found:
                    total[t] = total.get(t, 0) + int(c[0])
                found = [(t, np.zeros(1, "<u4"), np.array([c], "<i8")) for t, c in total.items()]
            rows = len(found) + 1
            columns = [
                pa.array([block] * rows, pa.int64()), pa.array([t for t, _, _ in found] + [None], pa.string()),
                pa.array([d.tobytes() for _, d, _ in found] + [None], pa.binary()), pa.array([c.tobytes() for _, _, c in found] + [None], pa.binary()),
                pa.array([None] * (rows - 1) + [piece.column("id").to_pylist()], pa.list_(piece.column("id").type)),
                pa.array([None] * (rows - 1) + [n.tolist()], pa.list_(pa.int64())),
                pa.array([0] * (rows - 1) + [int((n > 0).sum())], pa.int64()), pa.array([0] * (rows - 1) + [int(n.sum())], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["block", "term", "at", "tf", "ids", "sizes", "n_docs", "n_terms"])
            block += 1

    return src.mapInArrow(run, f"block long, term string, at binary, tf binary, ids array<{kind}>, sizes array<long>, n_docs long, n_terms long")


def _masks(places: list[np.ndarray], n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The documents that hold a term, in order of their masks; the offsets of
    the masks in them; and the masks as rows of booleans, a column a term."""
    words = -(-len(places) // 64)
    mask = np.zeros((n_docs, words), np.uint64)
    for j, at in enumerate(places):
        mask[at, j // 64] |= np.uint64(1) << np.uint64(j % 64)
    held = np.flatnonzero(mask.any(1))
    mask = mask[held]
    order = np.lexsort(mask.T)
    mask = mask[order]
    first = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]).any(1)]) if len(held) else np.empty(0, np.int64)
    bits = np.unpackbits(mask[first].astype("<u8").view(np.uint8).reshape(len(first), words * 8), axis=1, bitorder="little")
    return held[order], np.r_[first, len(held)], bits[:, : len(places)].astype(bool)


def best_of_block(places: list[np.ndarray], gains: list[np.ndarray], rank: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``top`` documents with the highest sums of ``gains`` above 0 (ties
    by ``rank``), their sums, and how many documents were evaluated.

    ``places`` are the documents that hold each term, ascending."""
    docs, cut, bits = _masks(places, len(rank))
    bound = bits @ np.array([int(g.max()) for g in gains], np.int64)
    best_doc, best_sum, done = np.empty(0, np.int64), np.empty(0, np.int64), 0
    todo = np.argsort(-bound, kind="stable")
    sizes = np.diff(cut)
    at = 0
    while at < len(todo) and (len(best_sum) < top or best_sum[-1] <= bound[todo[at]]):
        to, size = at + 1, sizes[todo[at]]  # small masks go together
        while to < len(todo) and size + sizes[todo[to]] <= TOGETHER:
            size += sizes[todo[to]]
            to += 1
        d = np.concatenate([docs[cut[g] : cut[g + 1]] for g in todo[at:to]])
        total = np.zeros(len(d), np.int64)
        for own, gain in zip(places, gains, strict=True):
            i = np.minimum(np.searchsorted(own, d), len(own) - 1)
            total += np.where(own[i] == d, gain[i], 0)
        done += len(d)
        best_doc, best_sum = np.r_[best_doc, d[total > 0]], np.r_[best_sum, total[total > 0]]
        order = np.lexsort((rank[best_doc], -best_sum))[:top]
        best_doc, best_sum = best_doc[order], best_sum[order]
        at = to
    return best_doc, best_sum, done


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``top`` documents of each item."""
    terms = materialise(item_terms(items, item_id, item_text), "item-terms")
    found = materialise(postings(docs, bitmap(terms, "token"), doc_id, doc_text), "postings")
    sums = found.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    n_docs, n_terms = sums["n"], sums["l"]
    item_blocks = max(1, -(-terms.count() // ITEM_ROWS))

    df = found.where("term is not null").groupBy("term").agg(F.sum(F.octet_length("at") / 4).cast("long").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    of_term = terms.select("item_id", "term", F.pmod(F.xxhash64("item_id"), F.lit(item_blocks)).cast("int").alias("items"))
    of_term = of_term.groupBy("items", "term").agg(F.collect_list(F.struct("item_id")).alias("of")).join(df, "term").select("items", "term", "of", weight.alias("w"))
    hits = found.where("term is not null").select("block", "term", "at", "tf").join(of_term, "term")
    heads = found.where("term is null").select("block", F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("items"), "ids", "sizes")
    rows = hits.select("block", "items", "at", "tf", "w", F.col("of.item_id").alias("of")).unionByName(heads, allowMissingColumns=True)
    id_type, item_type = (x.schema[c].dataType.simpleString() for x, c in ((docs, doc_id), (items, item_id)))

    def score(key: tuple, t: pa.Table) -> pa.Table:
        held = t.column("ids").is_valid()
        head, t = t.filter(held), t.filter(pc.invert(held))
        ids = head.column("ids").combine_chunks().flatten()
        m = 10 + 90 * head.column("sizes").combine_chunks().flatten().to_numpy() * n_docs // max(1, n_terms)
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
        places, gains = [], []
        for at, tf, w in zip(t.column("at").to_pylist(), t.column("tf").to_pylist(), t.column("w").to_pylist(), strict=True):
            at, tf = np.frombuffer(at, "<u4").astype(np.int64), np.frombuffer(tf, "<i8")
            places.append(at)
            gains.append(w * (1_000_000_000 * tf // (1000 * tf + 8 * m[at])))
        of = t.column("of").combine_chunks()
        row = np.repeat(np.arange(len(of)), pc.list_value_length(of).to_numpy(zero_copy_only=False))
        name = of.flatten()
        coded = pc.dictionary_encode(name, null_encoding="encode")
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(code, kind="stable")
        out_item, out_doc, out_sum = [], [], []
        for group in np.split(order, np.flatnonzero(np.diff(code[order])) + 1) if len(order) else []:
            mine = row[group]
            d, s, _ = best_of_block([places[j] for j in mine], [gains[j] for j in mine], rank, top)
            out_item += [code[group[0]]] * len(d)
            out_doc.append(d)
            out_sum.append(s)
        none = np.empty(0, np.int64)
        return pa.table({
            "item_id": coded.dictionary.take(pa.array(out_item, pa.int64())), "doc_id": ids.take(pa.array(np.concatenate([none, *out_doc]))), "score": pa.array(np.concatenate([none, *out_sum])),
        })

    best = rows.groupBy("block", "items").applyInArrow(score, f"item_id {item_type}, doc_id {id_type}, score long")
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    some = best.withColumn("g", F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGE_GROUPS)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "g").orderBy(*order))).where(F.col("r") <= top)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("item_id", "rank", "doc_id", "score")
