"""Ranked search against brute force."""

import math
import random
import re

import numpy as np
import pytest

from demand_engine.llm import search
from demand_engine.llm import textops as tx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in TERM.findall(text or "")]


def _plain(docs, items, top=10):
    """Every item against every document, all scores sorted."""
    words = [(i, _terms(t)) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n_docs, n_terms = len(words), sum(len(w) for _, w in words)
    df = {}
    for _, w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(_terms(t))
    out = set()
    for item, terms in wanted.items():
        scored = []
        for i, w in words:
            m = 10 + 90 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t in terms if t in w)
            if s > 0:
                scored.append((-s, i is None, i))
        out |= {(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scored)[:top])}
    return out


@pytest.mark.parametrize("item_rows", [7, 50_000])
def test_search_against_brute_force(spark, monkeypatch, item_rows):
    monkeypatch.setattr(search, "ITEM_ROWS", item_rows)  # many item blocks, or one
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(150)] + ["Été", "日本", "ñ1"]
    text = lambda n: " ".join(rnd.choice(vocabulary[: rnd.choice([5, 40, 153])]) for _ in range(n))
    docs = [(i, text(rnd.randrange(1, 60))) for i in range(300)]
    docs += [(1000 + i, docs[0][1]) for i in range(30)]  # copies tie
    docs += [(400, None), (401, ""), (402, "!?"), (403, "W1 w1-w1_W2"), (404, text(5000)), (404, text(20)), (None, "w1 w2 w3")]
    items = [(i, text(rnd.randrange(1, 30))) for i in range(25)] + [(30, " ".join(vocabulary)), (31, None), (32, ""), (33, "nowhere"), (1, "w7 w9"), (34, docs[0][1])]
    d = spark.createDataFrame([(a, b, 1) for a, b in docs], "doc_id long, text string, item_id int").repartition(5)
    q = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, score int")
    got = search.search(d, q)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in got.collect()} == _plain(docs, items)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b"), (None, "b")], "item_id long, text string")
    assert search.search(docs.limit(0), items).collect() == []
    assert search.search(docs, items.limit(0)).collect() == []
    assert [tuple(r)[:3] for r in search.search(docs, items).orderBy("item_id").collect()] == [(None, 1, 1), (1, 1, 1)]


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    limits = dict(zip(("PIECE_BYTES",), (64,), strict=True))
    plain_parts, plain_pieces = tx.parts, tx.pieces
    monkeypatch.setattr(search.tx, "parts", lambda piece, text, cut: plain_parts(piece, text, cut, limits["PIECE_BYTES"]))
    monkeypatch.setattr(search.tx, "pieces", lambda batches, text: plain_pieces(batches, text, limits["PIECE_BYTES"]))
    rnd = random.Random(2)
    docs = [(i, " ".join(f"w{rnd.randrange(30)}" for _ in range(rnd.choice([3, 8, 300])))) for i in range(40)] + [(50, "x" * 500 + " w1")]
    items = [(1, "w1 w2 w3"), (2, "x" * 500)]
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == _plain(docs, items)


def test_masks_leave_documents_that_cannot_reach_the_best():
    rnd = np.random.default_rng(1)
    n = 5000
    places = [np.flatnonzero(rnd.random(n) < p) for p in (0.9, 0.9, 0.5, 0.01, 0.002)]
    gains = [rnd.integers(w - w // 10, w, len(p)) for p, w in zip(places, (10, 12, 40, 900, 2000), strict=True)]
    doc, total, evaluated = search.best_of_block(places, gains, np.arange(n), 10)
    sums = np.zeros(n, np.int64)
    for p, g in zip(places, gains, strict=True):
        sums[p] += g
    order = np.lexsort((np.arange(n), -sums))[:10]
    assert doc.tolist() == order.tolist() and total.tolist() == sums[order].tolist()
    assert evaluated < n // 4
