"""Phrase mining against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from demand_engine.llm import phrases
from demand_engine.llm import textops as tx


def _plain(docs, least, longest, top):
    """All phrases of all lengths counted; every cut and every extension tried."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in found.items():
            for k in range(2, len(p)):
                gone |= {p[i : i + k] for i in range(len(p) - k + 1) if 100 * a >= 100 * c[p[i : i + k]]}
        rows = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], score))
        out |= {(lang, i + 1, *r[3:]) for i, r in enumerate(sorted(rows)[:top])}
    return out


def _texts(rnd, count):
    vocabulary = [f"w{i}" for i in range(40)] + ["été", "%%", "a\x01b", "日本"]
    fixed = ["the red fox ran home", "New York City", "w1 w1 w1 w1", "one two\tthree"]
    for _ in range(count):
        words = [rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(vocabulary[: rnd.choice([3, 12, 44])]) + rnd.choice(["", "", "", ".", "\n", "  "]) for _ in range(rnd.randrange(40))]
        yield rnd.choice(["en", "en", "en", "fr", None]), " ".join(words)


@pytest.mark.parametrize(("least", "longest", "top", "buckets"), [(3, 5, 10_000, 8), (2, 4, 50, 40), (2, 5, 10_000, 40), (4, 2, 100, 3)])
def test_phrases_against_brute_force(spark, least, longest, top, buckets):
    rnd = random.Random(least * longest)
    docs = [*_texts(rnd, 250), (None, None), ("en", ""), ("und", "new york, new york"), ("de", ".;:!?\x0b"), ("en", "the " * 300)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))  # many buckets begin and end amid shared first words
    try:
        df = spark.createDataFrame([(a, b, 1) for a, b in docs], "lang string, text string, phrase int").repartition(4)
        got = phrases.collocations(df, least=least, longest=longest, top=top)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert {tuple(r) for r in got.collect()} == _plain(docs, least, longest, top)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_phrases_of_an_empty_table_and_products_past_64_bits(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []
    a, n = 4_000_000_000, 9_000_000_000_000
    rows = spark.createDataFrame([("en", "a b", a, ["a", "b"], [a + 7, a], [a + 5, a], False, False)], "lang string, phrase string, c long, words array<string>, first_counts array<long>, last_counts array<long>, absorbed_right boolean, absorbed_left boolean")
    got = phrases.scored(rows, spark.createDataFrame([("en", n)], "lang string, n long"), 3).first()
    assert (got["l"], got["r"], got["score"]) == (a + 7, a + 5, 1000 * a * n // ((a + 7) * (a + 5)))


def test_long_texts_are_counted_in_parts(spark, monkeypatch):
    plain_parts, plain_pieces = tx.parts, tx.pieces
    monkeypatch.setattr(phrases.tx, "parts", lambda piece, text, cut: plain_parts(piece, text, cut, 100))
    monkeypatch.setattr(phrases.tx, "pieces", lambda batches, text: plain_pieces(batches, text, 100))
    docs = [("en", ". ".join(t for _, t in _texts(random.Random(3), 60))), ("en", "no break " * 90)]
    got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), least=3)
    assert {tuple(r) for r in got.collect()} == _plain(docs, 3, 5, 2000)
