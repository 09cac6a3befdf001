"""Quality classifier by nearest-neighbour voting.

Labelled documents (a bounded sample, chosen by hash) are drawn as
latent-semantic vectors: hashed byte trigrams, byte classes and repeated
words, centred and
projected on their leading singular directions. The labelled vectors and
the projection are broadcast (their size is fixed by the parameters); every
document's cosines to all of them come from blocked matrix products, and
the labels of its nearest neighbours are weighted by similarity.

Features come from the text alone. Bounds: ``max_labelled`` documents,
``FEATURES`` features, ``dims`` directions; at the defaults the
broadcast is about 4 MB.

Cases: a null or empty text has the features of an empty text and gets a
score from its neighbours like any other; labels without a document, null
labels and null ids are not learned from; several labels of one id are all
used; without any label to learn from every score is ``prior``; repeated rows score
alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx

HASHED = 4096
#: Byte classes, after the hashed trigrams: lower, upper, digits, white space, plain marks, other ASCII, the rest.
_CLASS = np.full(256, 6, np.int64)
_CLASS[:0x80] = 5
_CLASS[0x61:0x7B], _CLASS[0x41:0x5B], _CLASS[0x30:0x3A] = 0, 1, 2
_CLASS[~tx.SPACED] = 3
_CLASS[list(b".,;:'\"-()")] = 4
FEATURES = HASHED + 7 + 2
_CHUNK = 1 << 20


@dataclass(frozen=True)
class Neighbours:
    """A fitted model: projection, labelled vectors and their labels."""

    mean: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    power: float
    prior: float


def features(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row per text: roots of the shares of hashed byte trigrams, of byte
    classes, and of words equal to the word one or two before."""
    n = len(off) - 1
    out = np.zeros((n, FEATURES), np.float32)
    starts, ends, at = tx.tokens(buf, off, tx.SPACED)
    ids, _ = tx.word_ids(buf, starts, ends)
    for i in range(n):
        a, b = int(off[i]), int(off[i + 1])
        total = np.zeros(HASHED, np.int64)
        kinds = np.zeros(7, np.int64)
        for p in range(a, b, _CHUNK):
            kinds += np.bincount(_CLASS[buf[p : min(p + _CHUNK, b)]], minlength=7)
            x = buf[p : min(p + _CHUNK + 2, b)].astype(np.uint32)
            h = (x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA6B)) ^ (x[2:] * np.uint32(0xC2B2AE35))
            total += np.bincount((h * np.uint32(0x27D4EB2F)) >> np.uint32(20), minlength=HASHED)
        own = ids[at[i] : at[i + 1]]
        if b > a:
            out[i, :HASHED] = np.sqrt(total / max(b - a - 2, 1))
            out[i, HASHED : HASHED + 7] = np.sqrt(kinds / (b - a))
        for k in (1, 2):
            if len(own) > k:
                out[i, HASHED + 6 + k] = np.sqrt((own[k:] == own[:-k]).mean())
    return out


def _latent(x: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    z = (x - mean) @ axes
    return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)


def fit(x: np.ndarray, labels: np.ndarray, dims: int, k: int, power: float, prior: float) -> Neighbours:
    """Latent directions and labelled vectors of the sample's features."""
    mean = x.mean(axis=0) if len(x) else np.zeros(FEATURES, np.float32)
    if len(x):
        values, axes = np.linalg.eigh((x - mean) @ (x - mean).T if len(x) < FEATURES else (x - mean).T @ (x - mean))
        top = np.argsort(-values)[:dims]
        axes = axes[:, top]
        if len(x) < FEATURES:  # directions of the features from those of the rows
            axes = (x - mean).T @ axes
            axes /= np.maximum(np.linalg.norm(axes, axis=0), 1e-12)
    else:
        axes = np.zeros((FEATURES, dims), np.float32)
    axes = axes.astype(np.float32)
    return Neighbours(mean.astype(np.float32), axes, _latent(x, mean, axes).astype(np.float32), labels.astype(np.float32), k, power, prior)


def votes(model: Neighbours, z: np.ndarray) -> np.ndarray:
    """Similarity-weighted share of label 1 among the ``k`` nearest."""
    if not len(model.labels):
        return np.full(len(z), model.prior)
    cosines = z @ model.vectors.T
    k = min(model.k, len(model.labels))
    near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
    weight = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(np.float64) ** model.power + 1e-9
    return np.clip((weight * model.labels[near]).sum(1) / weight.sum(1), 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_labelled: int, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Features of the whole texts and labels of at most ``max_labelled``
    labelled ids outside the held-out fold, half of each label where there
    are enough, in order of a hash of the id. The tasks make the features,
    so the driver gets ``max_labelled`` rows of fixed length."""
    held = F.pmod(F.crc32(F.col("id").cast("string").cast("binary")), F.lit(folds)) == 0
    known = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label")).where("id is not null and label in (0, 1)").where(~held)
    order = [F.xxhash64(F.col("id"), F.lit(17)), F.col("id")]
    picked = [known.where(F.col("label") == y).orderBy(*order).limit(max_labelled // 2) for y in (0, 1)]
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("id is not null")
    # bounded by max_labelled rows, so it may be broadcast
    wanted = texts.join(F.broadcast(picked[0].union(picked[1])), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text"):
            x = features(*tx.text_bytes(piece.column("text")))
            yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("label"), pa.array([row.tobytes() for row in x], pa.binary())], ["id", "label", "x"])

    drawn = wanted.mapInArrow(run, f"id {texts.schema['id'].dataType.simpleString()}, label int, x binary")
    # one row for each id and label, also where rows repeat
    rows = drawn.groupBy("id", "label").agg(F.min("x").alias("x")).toArrow()
    rows = rows.take(pa.compute.sort_indices(rows, [("id", "ascending"), ("label", "ascending")]))
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float32).reshape(-1, FEATURES)
    return x, rows.column("label").to_numpy().astype(np.float32)


def quality_scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = 3000, dims: int = 64,
    k: int = 15, power: float = 2.0, threshold: float = 0.3, prior: float = 0.5, folds: int = 5,
) -> DataFrame:
    """One row per document: held_out, score (0 to 1), predicted."""
    model = fit(*labelled_sample(docs, labels, id_col, text_col, label_col, max_labelled, folds), dims, k, power, prior)
    # plain values: executors need not have this package's classes
    shared = docs.sparkSession.sparkContext.broadcast(SimpleNamespace(**vars(model)))
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for piece in tx.pieces(batches, "text"):
            scores = np.empty(piece.num_rows)
            for at in range(0, piece.num_rows, 1024):
                buf, off = tx.text_bytes(piece.column("text").slice(at, 1024))
                scores[at : at + 1024] = votes(m, _latent(features(buf, off), m.mean, m.axes))
            held = tx.crc_mod(piece.column("id"), folds) == 0
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(held), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["id", "held_out", "score", "predicted"]
            )

    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)
