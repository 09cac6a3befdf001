"""Language-model scores of whole documents.

The model is log-bilinear: a token's context is a vector, the sum of the
vectors of the two words before it (a table for each place) and the mean of
the vectors of up to ``WINDOW`` words before it; a word's score is the product
of its output vector with it, plus a bias. Words that training text holds
often enough have vectors of their own; the rest share vectors by count band
and shape (marks, bytes beyond ASCII, ending), and take a share of their
class by count. The count that a word needs grows with the text's bytes to
the power 0.6, so the number of own words grows with the corpus, and is at
most ``OWN_SCALE / 2`` times the bytes to the power 0.4.

Training is noise-contrastive estimation in numpy with sampled noise, over
all training tokens: in each round a piece of text starts from the shared
weights, takes small steps through its tokens, and gives back what it
changed; changes are averaged row by row of the tables, by how often a piece
meets the row. Probabilities are normalised in two levels by batched matrix
products: the group of a word among all groups, then the word in its group;
there are about as many groups as words in one. They sum to one over all
known words and one unknown word of each shape.

Counts cover all training documents. Each piece of text sends its distinct
words, once, to the bucket of their hash; buckets add them up and answer with
the totals, so a word that is in every document moves once per piece.

Cases: a null or empty text is its end token alone; a null id hashes as the
empty text; without training documents every word is unknown and N = V = 0;
repeated rows are scored (and learned) one by one; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .scratch import materialise

BUCKET_BYTES = 16 << 20
#: A word has its own vectors from (bytes of all texts) ** 0.6 / OWN_SCALE training tokens on.
OWN_SCALE = 256
WINDOW = 16
_BANDS = np.array([2, 5, 21, 101])  # counts 0-1 | 2-4 | 5-20 | 21-100 | more
_ENDINGS = 16
_SHAPES = 4 * _ENDINGS
#: Classes 0 to TAIL - 1 are those of words without own vectors, TAIL is the end, own words follow.
TAIL = (len(_BANDS) + 1) * _SHAPES
_END = TAIL


def _squeeze(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _restore(blob: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), kind)


def shapes(words: pa.Array) -> np.ndarray:
    """Whether a word ends in a mark of punctuation, whether it has bytes
    beyond ASCII, and its last two bytes before the mark, in 16 kinds."""
    if not len(words):
        return np.empty(0, np.int64)
    buf, off = tx.text_bytes(words)
    in_mark = np.isin(buf[off[1:] - 1], np.frombuffer(b".,;:!?", np.uint8)).astype(np.int64)
    last = np.maximum(off[1:] - 1 - in_mark, off[:-1])
    ending = buf[last].astype(np.int64) * 31 + buf[np.maximum(last - 1, off[:-1])]
    return in_mark + 2 * (np.maximum.reduceat(buf, off[:-1]) >= 0x80) + 4 * (ending % 61 % _ENDINGS)


def tail_class(counts: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Class of words without vectors of their own; unknown words count 0."""
    return np.searchsorted(_BANDS, counts, "right") * _SHAPES + shape


def least_count(total_bytes: int) -> int:
    """Training tokens from which on a word has its own vectors."""
    return max(5, int(total_bytes**0.6 / OWN_SCALE))


def read_pieces(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int, buckets: int) -> DataFrame:
    """kind 0: a row per piece of text: ids, lengths, tokens, and the places
    of its words in the buckets' lists; kind 1: a row per piece and bucket:
    distinct words and their training counts."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            buf, off = tx.text_bytes(piece.column("text"))
            buf = tx.LOWER[buf]
            starts, ends, at = tx.tokens(buf, off, tx.SPACED)
            ids, words = tx.word_ids(buf, starts, ends)
            held_out = tx.crc_mod(piece.column("id"), folds) == held
            learn = np.repeat(~held_out, np.diff(at))
            counts = np.bincount(ids[learn], minlength=len(words)).astype("<i8")
            bucket = (tx.hash_words(words) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            name = uuid.uuid4().int >> 65
            rows: dict[str, list] = {c: [] for c in ("kind", "piece", "bucket", "ids", "held", "lengths", "a", "b", "c")}

            def add(**row) -> None:
                for c in rows:
                    rows[c].append(row.get(c))

            add(kind=0, piece=name, ids=piece.column("id").to_pylist(), held=held_out.tolist(), lengths=np.diff(at).tolist(), a=_squeeze(ids.astype("<i4")), b=_squeeze(order.astype("<i4")), c=_squeeze(shapes(words).astype("u1")))
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1)).tolist()
            for i, j in zip(cuts, [*cuts[1:], len(order)], strict=False):
                own = order[i:j]
                text = b"\n".join(words.take(pa.array(own)).to_pylist())
                add(kind=1, piece=name, bucket=int(bucket[own[0]]), a=zstandard.ZstdCompressor(level=3).compress(text), b=_squeeze(counts[own]))
            kinds = {"kind": pa.int32(), "piece": pa.int64(), "bucket": pa.int32(), "ids": pa.list_(piece.schema.field("id").type), "held": pa.list_(pa.bool_()), "lengths": pa.list_(pa.int64()), "a": pa.binary(), "b": pa.binary(), "c": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array(rows[c], k) for c, k in kinds.items()], list(kinds))

    return src.mapInArrow(run, f"kind int, piece long, bucket int, ids array<{id_kind}>, held array<boolean>, lengths array<long>, a binary, b binary, c binary")


def count_words(lists: DataFrame, least: int) -> DataFrame:
    """kind 0: a bucket's answer to a piece: totals, and codes of the words
    that it met ``least`` times; kind 1: those words; kind 2: the bucket's
    sums: tokens, words, and mass by tail class."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        texts = [unpack.decompress(x).split(b"\n") for x in table.column("a").to_pylist()]
        sent = np.concatenate([_restore(x, "<i8") for x in table.column("b").to_pylist()])
        coded = pa.array([w for t in texts for w in t], pa.large_binary()).dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        totals = np.bincount(index, sent, len(words)).astype(np.int64)
        best = np.flatnonzero(totals >= least)
        code = np.zeros(len(words), "<u4")
        code[best] = np.arange(1, len(best) + 1)
        known = totals > 0
        kinds = tail_class(totals, shapes(words))
        mass = np.bincount(kinds[known & (code == 0)], totals[known & (code == 0)] + 1.0, TAIL)
        at, out = 0, []
        for piece, t in zip(table.column("piece").to_pylist(), texts, strict=True):
            own = index[at : at + len(t)]
            at += len(t)
            out.append((0, piece, _squeeze(totals[own].astype("<i8")), _squeeze(code[own]), None, None, None))
        out += [(1, i + 1, None, None, int(totals[w]), words[w].as_py(), None) for i, w in enumerate(best)]
        out.append((2, 0, None, None, int(totals.sum()), None, [float(known.sum()), *mass.tolist()]))
        names = ["kind", "piece", "a", "b", "n", "word", "mass"]
        types = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.float64())]
        columns = [pa.array([x[i] for x in out], t) for i, t in enumerate(types)]
        return pa.table([pa.array([key[0].as_py()] * len(out), pa.int32()), *columns], names=["bucket", *names])

    return lists.groupBy("bucket").applyInArrow(run, "bucket int, kind int, piece long, a binary, b binary, n long, word binary, mass array<double>")


@dataclass(frozen=True)
class Counts:
    """Totals of the training tokens. ``own``: bucket and code of the words
    with own vectors as one sorted number, ``rank`` their class, ``mass`` the
    tokens of each class, one more for each of its words."""

    tokens: int
    words: int
    ends: int
    own: np.ndarray
    rank: np.ndarray
    mass: np.ndarray

    @property
    def floor(self) -> float:
        """log10 of the base model's denominator, N + V + 1."""
        return float(np.log10(self.tokens + self.words + 1))


def gather_counts(pieces: DataFrame, answers: DataFrame) -> Counts:
    """Corpus totals: sums over the buckets, and the words with own vectors
    (their number is bounded by ``least_count``)."""
    ends = pieces.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    sums = answers.where("kind = 2")
    tokens = sums.agg(F.sum("n")).first()[0] or 0
    tail = np.zeros(TAIL + 1)
    for r in sums.select(F.posexplode("mass")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        tail[r["pos"]] = r["n"]
    top = answers.where("kind = 1").orderBy(F.desc("n"), "word").select("n", (F.col("bucket").cast("long") * 2**32 + F.col("piece")).alias("key")).toArrow()
    n, key = (top.column(c).to_numpy() for c in ("n", "key"))
    mass = np.concatenate((tail[1:], [1.0], n + 1.0))
    mass[:_SHAPES] += 1  # one unknown word in each class of rare words
    order = np.argsort(key)
    return Counts(tokens + ends, int(tail[0]) + (ends > 0), ends, key[order], TAIL + 1 + order, mass)


def resolve(pieces: DataFrame, answers: DataFrame, counts: Counts, id_kind: str) -> DataFrame:
    """A row per piece: ids, held, n_tokens, n_known, base, inside (the sum
    of log10 p(word | class)) and the classes of its tokens, ends included."""
    # plain values: executors need not have this package's classes
    shared = pieces.sparkSession.sparkContext.broadcast(SimpleNamespace(own=counts.own, rank=counts.rank, mass=counts.mass, ends=counts.ends, floor=counts.floor))

    def run(key: tuple, own: pa.Table, got: pa.Table) -> pa.Table:
        m = shared.value
        out: dict[str, list] = {c: [] for c in ("ids", "held", "n_tokens", "n_known", "base", "inside", "classes")}
        got = got.sort_by("bucket")
        totals = [_restore(x, "<i8") for x in got.column("a").to_pylist()]
        for row in own.to_pylist():
            order = _restore(row["b"], "<i4")
            shape = _restore(row["c"], "u1").astype(np.int64)
            c, kind = np.zeros(len(order), np.int64), np.full(len(order), -1)
            if totals:
                c[order] = np.concatenate(totals)
                code = np.concatenate([_restore(x, "<u4") + (np.int64(b) << 32) for b, x in zip(got.column("bucket").to_pylist(), got.column("b").to_pylist(), strict=True)])
                special = np.flatnonzero(code & 0xFFFFFFFF)
                kind[order[special]] = m.rank[np.searchsorted(m.own, code[special])]
            kind = np.where(kind >= 0, kind, tail_class(c, shape))
            base = np.log10(c + 1.0) - m.floor
            inside = np.log10(c + 1.0) - np.log10(np.maximum(m.mass[kind], 1))
            tokens = _restore(row["a"], "<i4")
            lengths = np.array(row["lengths"], np.int64)
            off = np.concatenate(([0], np.cumsum(lengths)))
            per_doc = [np.array([x[tokens[a:b]].sum() for a, b in zip(off[:-1], off[1:], strict=True)]) for x in (base, inside)]
            known = tx.segment_sums((c > 0)[tokens], off)
            classes = np.insert(kind[tokens], off[1:], _END).astype("<i4")
            for name, x in zip(out, (row["ids"], row["held"], (lengths + 1).tolist(), (known + (m.ends > 0)).tolist(), (per_doc[0] + np.log10(m.ends + 1.0) - m.floor).tolist(), per_doc[1].tolist(), _squeeze(classes)), strict=True):
                out[name].append(x)
        kinds = [own.schema.field("ids").type, pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
        return pa.table({c: pa.array(out[c], k) for c, k in zip(out, kinds, strict=True)})

    schema = f"ids array<{id_kind}>, held array<boolean>, n_tokens array<long>, n_known array<long>, base array<double>, inside array<double>, classes binary"
    return pieces.groupBy("piece").cogroup(answers.groupBy("piece")).applyInArrow(run, schema)


def tables(counts: Counts, dims: int) -> SimpleNamespace:
    """The model before training, as plain arrays: ``two``, ``one`` and
    ``bag`` (context vectors), ``out`` and ``groups`` (output vectors; the
    last column is the bias, where contexts hold a one), shares of words and groups, the group of each word, and words
    in order of their groups. Groups hold about equal sums of root shares."""
    mass = counts.mass.copy()
    mass[_END] = counts.ends + 1
    share = mass + 0.01
    share /= share.sum()
    order = np.argsort(-share, kind="stable")
    root = np.cumsum(np.sqrt(share[order]))
    size = int(np.ceil(np.sqrt(len(share))))
    _, in_order = np.unique(np.minimum((root / root[-1] * size).astype(np.int64), size - 1), return_inverse=True)
    group = np.empty(len(share), np.int64)
    group[order] = in_order
    of_group = np.bincount(group, share)
    draw = np.random.default_rng(7)
    vectors = {k: draw.normal(0, 0.1, (len(share), dims)).astype(np.float32) for k in ("two", "one", "bag", "out")}
    vectors["groups"] = draw.normal(0, 0.1, (len(of_group), dims)).astype(np.float32)
    for k, p in (("out", share), ("groups", of_group)):
        vectors[k][:, -1] = np.log(p)
    at = np.searchsorted(in_order, np.arange(len(of_group) + 1))
    place = np.empty(len(share), np.int64)
    place[order] = np.arange(len(share))
    return SimpleNamespace(**vectors, share=share, of_group=of_group, group=group, order=order, place=place, at=at)


VECTORS = ("two", "one", "bag", "out", "groups")


def context(m: SimpleNamespace, classes: np.ndarray, first: np.ndarray, i: int, j: int) -> tuple[np.ndarray, SimpleNamespace]:
    """Context vectors of tokens i to j, a one last for the bias; ``first`` is
    the place of the first token of each token's text. A text starts after
    two ends."""
    at, start, base = np.arange(i, j), first[i:j], max(0, i - WINDOW)
    near = classes[base:j]
    one = np.where(at - 1 >= start, near[np.maximum(at - 1 - base, 0)], _END)
    two = np.where(at - 2 >= start, near[np.maximum(at - 2 - base, 0)], _END)
    low = np.maximum(at - WINDOW, start)
    share = (1 / np.maximum(at - low, 1)).astype(np.float32)[:, None]
    total = np.zeros((len(near) + 1, m.bag.shape[1]), np.float32)
    np.cumsum(m.bag.take(near, axis=0), axis=0, out=total[1:])
    low, at = low - base, at - base
    h = total.take(at, axis=0)
    h -= total.take(low, axis=0)
    h *= share
    h += m.two.take(two, axis=0)
    h += m.one.take(one, axis=0)
    h[:, -1] = 1
    return h, SimpleNamespace(two=two, one=one, near=near, low=low, at=at, share=share)


def _firsts(ids: np.ndarray) -> np.ndarray:
    """Places where a run of equal ids begins."""
    new = np.ones(len(ids), bool)
    np.not_equal(ids[1:], ids[:-1], out=new[1:])
    return np.flatnonzero(new)


def _descend(table: np.ndarray, power: np.ndarray, ids: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """One step on the rows ``ids`` (repeats add up), scaled by row."""
    order = np.argsort(ids)
    ids = ids[order]
    cuts = _firsts(ids)
    ids, slope = ids[cuts], np.add.reduceat(slope.take(order, axis=0), cuts, axis=0)
    grown = power[ids] + np.einsum("ij,ij->i", slope, slope) / slope.shape[1]
    power[ids] = grown
    slope *= rate
    slope /= np.sqrt(grown)[:, None]
    table[ids] = table.take(ids, axis=0) - slope


def contrast(h: np.ndarray, table: np.ndarray, target: np.ndarray, drawn: np.ndarray, shift: np.ndarray, noise: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slopes of the noise-contrastive loss: of the contexts, and rows of
    ``table`` with theirs. ``drawn`` stands for ``noise`` draws a token."""

    def odds(x: np.ndarray) -> np.ndarray:
        """1 / (1 + exp(x))"""
        np.minimum(x, np.float32(30), out=x)
        np.exp(x, out=x)
        x += 1
        return np.reciprocal(x, out=x)

    true, false = table.take(target, axis=0), table.take(drawn, axis=0)
    up = odds(shift[target] - np.einsum("ij,ij->i", h, true)) - 1
    down = h @ false.T
    odds(np.subtract(shift[drawn], down, out=down))
    down *= np.float32(noise / len(drawn))
    true *= up[:, None]
    true += down @ false
    slope = np.empty((len(target) + len(drawn), h.shape[1]), np.float32)
    np.multiply(h, up[:, None], out=slope[: len(target)])
    np.matmul(down.T, h, out=slope[len(target) :])
    return true, np.concatenate((target, drawn)), slope


def learn(m: SimpleNamespace, classes: np.ndarray, lengths: np.ndarray, passes: int, batch: int, noise: float, draws: int, rate: float, ease: float, seed: int) -> None:
    """Steps through the tokens of whole texts, ``batch`` at a time in random
    order; changes the tables of ``m``. Steps shrink by row as slopes add up,
    from ``ease`` on."""
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    draw = np.random.default_rng(seed)
    shift, group_shift = (np.log(noise * p).astype(np.float32) for p in (m.share, m.of_group))
    upto, group_upto = np.cumsum(m.share), np.cumsum(m.of_group)
    power = {k: np.full(len(getattr(m, k)), ease, np.float32) for k in VECTORS}
    starts = np.arange(0, len(classes), batch)
    for i in np.concatenate([draw.permutation(starts) for _ in range(passes)]).tolist():
        j = min(i + batch, len(classes))
        h, c = context(m, classes, first, i, j)
        drawn = np.minimum(np.searchsorted(upto, draw.random(draws)), len(upto) - 1)
        group_drawn = np.minimum(np.searchsorted(group_upto, draw.random(draws)), len(group_upto) - 1)
        target = classes[i:j]
        back, ids, slope = contrast(h, m.out, target, drawn, shift, noise)
        group_back, group_ids, group_slope = contrast(h, m.groups, m.group[target], group_drawn, group_shift, noise)
        back += group_back
        back[:, -1] = 0
        even = back * c.share
        spread = np.zeros((len(c.near) + 1, back.shape[1]), np.float32)
        cuts = _firsts(c.low)
        spread[c.low[cuts]] = np.add.reduceat(even, cuts, axis=0)
        spread[c.at] -= even
        _descend(m.out, power["out"], ids, slope, rate)
        _descend(m.groups, power["groups"], group_ids, group_slope, rate)
        _descend(m.two, power["two"], c.two, back, rate)
        _descend(m.one, power["one"], c.one, back, rate)
        _descend(m.bag, power["bag"], c.near, np.cumsum(spread, axis=0)[:-1], rate)


def one_round(resolved: DataFrame, m: SimpleNamespace, **how) -> SimpleNamespace:
    """The model after every piece of text has learnt from ``m`` and the
    changes are averaged. A row of a table counts by its tokens in a piece,
    an output row also by its expected draws as noise."""
    shared = resolved.sparkSession.sparkContext.broadcast(m)
    width, noise = m.out.shape[1], how["noise"]
    base = dict(zip(VECTORS, np.cumsum([0, *(len(getattr(m, k)) for k in VECTORS)]).tolist(), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        was = shared.value
        sums = {k: np.zeros((len(getattr(was, k)), width + 1)) for k in VECTORS}
        for batch in batches:
            for row in batch.to_pylist():
                lengths, held = np.array(row["n_tokens"], np.int64), np.array(row["held"], bool)
                classes = _restore(row["classes"], "<i4")[np.repeat(~held, lengths)].astype(np.int64)
                if not len(classes):
                    continue
                own = SimpleNamespace(**{k: getattr(was, k).copy() if k in VECTORS else getattr(was, k) for k in vars(was)})
                learn(own, classes, lengths[~held], seed=len(classes), **how)
                met = np.bincount(classes, minlength=len(was.share)).astype(float)
                weight = dict.fromkeys(VECTORS, met)
                weight["out"] = met + noise * len(classes) * was.share
                weight["groups"] = np.bincount(was.group, met) + noise * len(classes) * was.of_group
                for k in VECTORS:
                    change = getattr(own, k) - getattr(was, k)
                    sums[k][:, :width] += weight[k][:, None] * change
                    sums[k][:, width] += weight[k]
        for k in VECTORS:
            used = np.flatnonzero(sums[k][:, width])
            for i in range(0, len(used), 4096):
                rows = used[i : i + 4096]
                flat = pa.array(sums[k][rows].reshape(-1))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * (width + 1)), flat)
                yield pa.RecordBatch.from_arrays([pa.array(base[k] + rows), lists], ["row", "v"])

    changes = resolved.select("classes", "n_tokens", "held").mapInArrow(run, "row long, v array<double>")
    got = changes.groupBy("row").agg(*(F.sum(F.col("v")[i]).alias(f"v{i}") for i in range(width + 1))).toArrow()
    shared.destroy()
    rows = got.column("row").to_numpy()
    values = np.column_stack([got.column(f"v{i}").to_numpy() for i in range(width + 1)])
    change = np.zeros((sum(len(getattr(m, k)) for k in VECTORS), width))
    change[rows] = values[:, :width] / values[:, width:]
    after = SimpleNamespace(**vars(m))
    for k in VECTORS:
        table = getattr(m, k)
        # rounded, since the order of sums differs from run to run
        setattr(after, k, (np.round((table + change[base[k] : base[k] + len(table)]) * 65536) / 65536).astype(np.float32))
    return after


def log_probabilities(m: SimpleNamespace, classes: np.ndarray, first: np.ndarray, i: int, j: int, smooth: float) -> np.ndarray:
    """log10 p(class | context) of tokens i to j: the group among all groups,
    then the word in its group, one matrix product for each group."""
    h, _ = context(m, classes, first, i, j)
    target = classes[i:j]
    group = m.group[target]

    def chosen(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
        np.clip(scores, -60, 60, out=scores)
        np.exp(scores, out=scores)
        return scores[np.arange(len(at)), at] / scores.sum(1)

    p = np.concatenate([chosen(h[a : a + 1024] @ m.groups.T, group[a : a + 1024]) for a in range(0, len(h), 1024)]).astype(np.float64)
    # rows by group, so that a group's words meet one run of them
    order = np.argsort(group, kind="stable")
    h, group = h.take(order, axis=0), group[order]
    word = m.place[target[order]] - m.at[group]
    inside = np.empty(len(order))
    cuts = _firsts(group).tolist()
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = m.order[m.at[group[a]] : m.at[group[a] + 1]]
        inside[a:b] = chosen(h[a:b] @ m.out.take(own, axis=0).T, word[a:b])
    p[order] *= inside
    return np.log10((1 - smooth) * p + smooth * m.share[target])


def train(resolved: DataFrame, counts: Counts, dims: int = 16, rounds: int = 1, least_steps: int = 1_000, batch: int = 2048, noise: float = 3.0, draws: int = 128, rate: float = 0.2, ease: float = 0.3) -> SimpleNamespace:
    """The trained model. Pieces of a small corpus go through their tokens
    again until all rounds together make ``least_steps`` steps."""
    m = tables(counts, dims)
    passes = max(1, -(-least_steps * batch // (rounds * max(1, counts.tokens))))
    for k in range(rounds):
        m = one_round(resolved, m, passes=min(passes, least_steps), batch=batch, noise=noise, draws=draws, rate=rate / 2**k, ease=ease)
    return m


def resolved_documents(docs: DataFrame, id_col: str, text_col: str, folds: int, held: int, bucket_bytes: int) -> tuple[DataFrame, Counts]:
    """Pieces of text with the classes of their tokens, and the counts."""
    id_kind = docs.schema[id_col].dataType.simpleString()
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    drawn = materialise(read_pieces(docs, id_col, text_col, folds, held, max(1, -(-total // bucket_bytes))), "pieces")
    pieces = drawn.where("kind = 0").select("piece", "ids", "held", "lengths", "a", "b", "c")
    answers = materialise(count_words(drawn.where("kind = 1").select("piece", "bucket", "a", "b"), least_count(total)), "counts")
    counts = gather_counts(pieces, answers)
    return materialise(resolve(pieces, answers.where("kind = 0").select("piece", "bucket", "a", "b"), counts, id_kind), "resolved"), counts


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, held: int = 2, smooth: float = 0.05,
    bucket_bytes: int = BUCKET_BYTES, **training,
) -> DataFrame:
    """One row per document: held_out, n_tokens, n_known, train_tokens,
    base_score and score (log10 probabilities of the whole text). ``training``
    goes to ``train``."""
    id_kind = docs.schema[id_col].dataType.simpleString()
    resolved, counts = resolved_documents(docs, id_col, text_col, folds, held, bucket_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(train(resolved, counts, **training))
    train_tokens = counts.tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("ids", "held", "n_tokens", "n_known", "base", "inside", "classes")}
                classes = _restore(row["classes"].as_py(), "<i4").astype(np.int64)
                lengths = row["n_tokens"].values.to_numpy()
                starts = np.cumsum(lengths) - lengths
                first = np.repeat(starts, lengths)
                token = np.concatenate([log_probabilities(shared.value, classes, first, a, min(a + 16384, len(classes)), smooth) for a in range(0, len(classes), 16384)])
                outer = np.add.reduceat(token, starts)
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, row["held"].values, row["n_tokens"].values, row["n_known"].values, pa.array(np.full(len(lengths), train_tokens, np.int64)), row["base"].values, pa.array(outer + row["inside"].values.to_numpy())],
                    ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    schema = f"id {id_kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return resolved.mapInArrow(run, schema).withColumnRenamed("id", id_col)
