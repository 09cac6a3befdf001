"""Main text of web pages by a recurrent block labeller.

A page is read as its sequence of text blocks. Each block has the average of
hashed vectors of its tag path (open elements and the words of their class,
id and role), the average of hashed vectors of its words, and a few numbers
(length, linked share, place). A bidirectional LSTM in numpy reads the whole
sequence both ways and labels every block; blocks labelled as main text are
joined in page order.

The labeller is trained on a bounded sample of pages: at most ``SAMPLE_PAGES``
pages of at most ``SAMPLE_CHARS`` characters, those with the least hashes.
Blocks of the sample that lie in elements whose tag or class names the part
(article, main; nav, header, footer, aside, form, advert) teach as they are;
their texts also fill ``PRACTICE_PAGES`` made-up pages in other layouts, whose
answers are known. All pages are then labelled by the network alone.

Cases: null or empty pages, and pages without main text, give an empty text;
broken or missing tags are read as far as they go; a page that is plain text
is one block; repeated rows are read alike; an empty table gives no rows;
other columns are ignored. Memory follows the longest page, about ten times
its bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bilstm
from . import textops as tx
from .htmlblocks import blocks
from .pagemaker import MAIN, MARK, PARTS, PageMaker

SAMPLE_PAGES = 300
SAMPLE_CHARS = 20_000
PRACTICE_PAGES = 2_000
#: Rows of the tables of tag-path and word vectors; width; states each way.
PATH_ROWS, WORD_ROWS, WIDTH, HIDDEN = 1 << 11, 1 << 12, 12, 16
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.01, 17
#: Blocks of several pages that are labelled together, padding included.
PLACES = 1 << 15
PIECE_BYTES = 2 << 20
KEEP = 0.5

Block = tuple[list[str], str, float]
_OTHER = frozenset({"nav", "header", "footer", "aside", "form", *(f".{x}" for x in ("nav", "menu", "ad", "ads", "advert", "advertisement", "footer", "sidebar", "comments", "cookie", "share", "form"))})


def own_label(path: list[str]) -> int:
    """1, 0 or -1 (unknown): what a block's own elements say of it."""
    if any(x in _OTHER for x in path):
        return 0
    return 1 if "article" in path or "main" in path else -1


class Reader:
    """Blocks of pages as the labeller's inputs; remembers words' numbers."""

    def __init__(self) -> None:
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def _bag(self, kind: int, rows: int, lists: list[list[str]]) -> bilstm.Bag:
        known = self.known[kind]
        if len(known) > 200_000:
            known.clear()
        out = []
        for tokens in lists:
            for x in tokens:
                n = known.get(x)
                if n is None:
                    n = known[x] = zlib.crc32(x.encode("utf-8", "replace")) % rows
                out.append(n)
        off = np.zeros(len(lists) + 1, np.int64)
        np.cumsum([len(x) for x in lists], out=off[1:])
        return np.array(out, np.int64), off

    def inputs(self, pages: list[list[Block]]) -> tuple[list[bilstm.Bag], np.ndarray, np.ndarray]:
        """Bags, numbers and lengths of pages that have blocks."""
        every = [b for page in pages for b in page]
        words = [text.lower().split() for _, text, _ in every]
        # the last two elements also count by their place
        paths = [[*p, *(f"{i}{x}" for i, x in enumerate(reversed(p[-2:])))] for p, _, _ in every]
        n_words = np.array([len(x) for x in words], float)
        lengths = np.array([len(p) for p in pages], np.int64)
        place = np.arange(len(every)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        ends = np.array([text[-1] in ".!?…:\"'”»" for _, text, _ in every], float)
        numbers = np.stack([
            np.log1p(n_words) / 4, np.array([x for _, _, x in every], float), ends, place / np.repeat(lengths, lengths), np.log1p(place) / 5, np.array([len(p) for p, _, _ in every]) / 10,
        ], axis=1)
        return [self._bag(0, PATH_ROWS, paths), self._bag(1, WORD_ROWS, words)], numbers, lengths


def _marked(page: str) -> tuple[list[Block], list[int]]:
    found = blocks(page)
    labels = [int(MARK in text) for _, text, _ in found]
    return [(p, " ".join(text.replace(MARK, " ").split()), x) for p, text, x in found], labels


def fit(sample: list[str], seed: int = SEED, practice: int = PRACTICE_PAGES, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Weights of the labeller from sampled pages, on the driver."""
    real = [b for b in map(blocks, sample) if b]
    labels = [[own_label(p) for p, _, _ in page] for page in real]
    pick = lambda want: [text for page, own in zip(real, labels, strict=True) for (_, text, _), y in zip(page, own, strict=True) if y == want]
    main, other = pick(1), pick(0)
    if not main:  # no page names its parts: long blocks stand for main text
        main = [text for page in real for _, text, _ in page if len(text.split()) >= 20] or ["Nothing else is known of the text of these pages."]
    maker = PageMaker(main, other or ["Home"], seed)
    made = [x for x in (_marked(maker.page()) for _ in range(practice)) if x[0]]
    pages, labels = real + [b for b, _ in made], labels + [y for _, y in made]
    w = bilstm.new_weights((PATH_ROWS, WORD_ROWS), WIDTH, 6, HIDDEN, seed)
    rnd, reader, memory, step = np.random.default_rng(seed), Reader(), {}, 0
    steps = epochs * -(-len(pages) // BATCH)
    for _ in range(epochs):
        # pages of like length go together, in an order that changes
        order = np.argsort([len(p) + rnd.random() * 4 for p in pages], kind="stable")
        for part in rnd.permutation(-(-len(order) // BATCH)):
            own = order[part * BATCH : (part + 1) * BATCH]
            bags, numbers, lengths = reader.inputs([pages[i] for i in own])
            y = np.array([v for i in own for v in labels[i]])
            _, grads = bilstm.gradients(w, bags, numbers, lengths, y)
            step += 1
            bilstm.adam(w, grads, memory, step, RATE * (1 - 0.9 * step / (steps + 1)))
    return {k: v.astype(np.float32) for k, v in w.items()}


def label(w: dict[str, np.ndarray], pages: list[list[Block]], reader: Reader) -> list[np.ndarray]:
    """For each page which of its blocks are main text. Pages of like length
    go through the network together."""
    out: list[Any] = [np.empty(0, bool)] * len(pages)
    todo = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    at = 0
    while at < len(todo):
        to = at + 1
        while to < len(todo) and len(pages[todo[to]]) * (to + 1 - at) <= PLACES:
            to += 1
        own = todo[at:to]
        bags, numbers, lengths = reader.inputs([pages[i] for i in own])
        x = np.concatenate([*(bilstm.bag_means(w[f"table{k}"], bag) for k, bag in enumerate(bags)), numbers], axis=1)
        good = bilstm.logits(w, x, lengths) > np.log(KEEP / (1 - KEEP))
        for i, y in zip(own, np.split(good, np.cumsum(lengths)[:-1]), strict=True):
            out[i] = y
        at = to
    return out


def sample_pages(pages: DataFrame, id_col: str, html_col: str, count: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> list[str]:
    """At most ``count`` pages of at most ``chars`` characters, by least hash."""
    src = pages.select(pages[id_col].alias("id"), pages[html_col].alias("html")).where((F.length("html") > 0) & (F.length("html") <= chars))
    src = src.select("html", F.xxhash64(F.col("id").cast("string"), "html").alias("h"))
    # about twice as many rows as wanted pass the threshold, however many there
    # are, so that what is sorted and sent does not grow with the tasks
    share = min(1.0, 2 * count / max(1, src.count()))
    near = src.where(F.col("h") <= F.lit(int(-(2**63) + share * (2**64 - 2**11))))
    return [r["html"] for r in near.orderBy("h", "html").limit(count).collect()]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    weights = pages.sparkSession.sparkContext.broadcast(fit(sample_pages(pages, id_col, html_col)))
    src = pages.select(pages[id_col].alias(id_col), pages[url_col].alias(url_col), pages[html_col].alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for piece in tx.pieces(batches, "html", PIECE_BYTES):
            found = [blocks(x or "") for x in piece.column("html").to_pylist()]
            texts = ["\n\n".join(text for (_, text, _), y in zip(page, good, strict=True) if y) for page, good in zip(found, label(weights.value, found, reader), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [id_col, url_col, "text", "n_chars"])

    kinds = [f"`{c}` {src.schema[c].dataType.simpleString()}" for c in (id_col, url_col)]
    return src.mapInArrow(run, f"{kinds[0]}, {kinds[1]}, text string, n_chars long")
