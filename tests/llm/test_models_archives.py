"""Language model, classifier and archives: brute force, held-out figures, round trips."""

import math
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.llm import classifier, lm, warc


def _held(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


def _base_scores(rows):
    tokens = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + ["end"]) for i, t in rows]
    c = Counter(w for i, ws in tokens if _held(i, 7) != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    return [(str(i), _held(i, 7) == 2, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for i, ws in tokens]


def test_lm_counts_and_base_scores(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(["The", "the", "of", "é!", "rare%d" % i, "x."], rng.integers(0, 30)))) for i in range(80)]
    rows += [(None, "the of"), (90, None), (91, ""), (3, rows[3][1])]
    df = spark.createDataFrame([(int(i) if i is not None else None, t) for i, t in rows], "doc_id long, text string").withColumns({"held": F.lit(1), "piece": F.lit("x")})
    got = lm.score_documents(df, least_steps=5, bucket_bytes=200).collect()
    have = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert have == sorted((*x[:5], round(x[5], 6)) for x in _base_scores(rows))
    assert all(r["score"] < 0 for r in got)
    assert lm.score_documents(df.limit(0)).count() == 0


def _small_model(words=40, dims=6, seed=3):
    mass = np.random.default_rng(seed).integers(1, 200, lm.TAIL + 1 + words).astype(float)
    return lm.tables(SimpleNamespace(mass=mass, ends=50), dims)


def _texts(m, lengths, seed=4):
    return np.random.default_rng(seed).integers(0, len(m.share), sum(lengths)), np.array(lengths, np.int64)


def _plain_context(m, text, at):
    one, two = (int(text[at - k]) if at >= k else lm._END for k in (1, 2))
    near = [m.bag[int(w)].astype(float) for w in text[max(0, at - lm.WINDOW) : at]]
    h = m.two[two].astype(float) + m.one[one] + (np.mean(near, axis=0) if near else 0)
    return np.append(h[:-1], 1.0), one, two


def test_lm_own_words_follow_the_corpus(spark):
    rows = [(i, " ".join([f"w{j}" for j in range(40) if i % (j + 1) == 0] + ["x." * (i % 3)])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    _, counts = lm.resolved_documents(df, "doc_id", "text", 7, 2, 200)
    c = Counter(w for i, t in rows if _held(i, 7) != 2 for w in t.split())
    size = sum(len(t) for _, t in rows)
    own = sorted((n + 1 for n in c.values() if n >= lm.least_count(size)), reverse=True)
    assert len(own) > 10 and counts.mass[lm.TAIL + 1 :].tolist() == own
    # every other known word is in a class, with one unknown word for each shape
    assert counts.mass[: lm.TAIL].sum() == sum(n + 1 for n in c.values() if n < lm.least_count(size)) + lm._SHAPES
    sizes = [10**k for k in range(4, 15)]
    words = [s**0.4 * lm.OWN_SCALE / 2 for s in sizes]
    assert all(s / 2 / lm.least_count(s) <= 1.1 * w for s, w in zip(sizes[2:], words[2:], strict=True)) and words == sorted(words)


def test_lm_probabilities_sum_to_one_and_equal_a_plain_version():
    m = _small_model()
    classes, lengths = _texts(m, [30, 1, 45, 2])
    lm.learn(m, classes, lengths, 3, 16, 3.0, 8, 0.2, 0.3, 1)
    v = len(m.share)
    # the same context before every word
    texts = np.column_stack((np.full(v, 5), np.full(v, v - 1), np.arange(v))).reshape(-1)
    first = np.repeat(np.arange(v) * 3, 3)
    p = 10 ** lm.log_probabilities(m, texts, first, 0, len(texts), 0.05)
    assert p.reshape(v, 3)[:, 2].sum() == pytest.approx(1, abs=1e-5)
    h, _, _ = _plain_context(m, [5, v - 1], 2)
    for w in range(0, v, 17):
        g = m.group[w]
        among = np.exp(m.groups.astype(float) @ h)
        inside = {x: math.exp(m.out[x].astype(float) @ h) for x in range(v) if m.group[x] == g}
        want = 0.95 * among[g] / among.sum() * inside[w] / sum(inside.values()) + 0.05 * m.share[w]
        assert p[3 * w + 2] == pytest.approx(want, rel=1e-4)
    # cut anywhere, a text has the same probabilities
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    whole = lm.log_probabilities(m, classes, first, 0, len(classes), 0.05)
    cut = np.concatenate([lm.log_probabilities(m, classes, first, a, min(a + 7, len(classes)), 0.05) for a in range(0, len(classes), 7)])
    np.testing.assert_allclose(whole, cut, atol=1e-4)


def test_lm_step_equals_plain_noise_contrastive_estimation():
    noise, draws, rate, ease, seed = 3.0, 8, 0.2, 0.3, 1
    m, was = _small_model(), _small_model()
    lengths = [20, 1, 5]
    classes, sizes = _texts(m, lengths)
    lm.learn(m, classes, sizes, 1, 100, noise, draws, rate, ease, seed)
    draw = np.random.default_rng(seed)
    draw.permutation(1)
    drawn = [np.searchsorted(np.cumsum(p), draw.random(draws)) for p in (was.share, was.of_group)]
    slopes = {k: np.zeros(getattr(was, k).shape) for k in lm.VECTORS}
    start = 0
    for n in lengths:
        text = classes[start : start + n]
        start += n
        for at, w in enumerate(text):
            h, one, two = _plain_context(was, text, at)
            back = np.zeros(len(h))
            for k, target, sample, p in (("out", w, drawn[0], was.share), ("groups", was.group[w], drawn[1], was.of_group)):
                table = getattr(was, k).astype(float)
                for c, weight, real in [(target, 1.0, 1.0), *((c, noise / draws, 0.0) for c in sample)]:
                    odds = 1 / (1 + math.exp(-(table[c] @ h - math.log(noise * p[c]))))
                    slopes[k][c] += weight * (odds - real) * h
                    back += weight * (odds - real) * table[c]
            back[-1] = 0
            slopes["one"][one] += back
            slopes["two"][two] += back
            near = text[max(0, at - lm.WINDOW) : at]
            for x in near:
                slopes["bag"][x] += back / len(near)
    for k in lm.VECTORS:
        size = ease + (slopes[k] ** 2).mean(1, keepdims=True)
        np.testing.assert_allclose(getattr(m, k), getattr(was, k) - rate * slopes[k] / np.sqrt(size), atol=2e-5)


def test_lm_round_averages_the_pieces(spark):
    m = _small_model()
    how = {"passes": 1, "batch": 16, "noise": 3.0, "draws": 8, "rate": 0.2, "ease": 0.3}
    pieces = [(_texts(m, [12, 9], s), [False, s == 1]) for s in range(3)]
    rows = [(lm._squeeze(c.astype("<i4")), n.tolist(), held) for (c, n), held in pieces]
    got = lm.one_round(spark.createDataFrame(rows, "classes binary, n_tokens array<long>, held array<boolean>").repartition(2), m, **how)
    change, weight = {k: 0.0 for k in lm.VECTORS}, {k: 0.0 for k in lm.VECTORS}
    for (c, n), held in pieces:
        kept = c[np.repeat(~np.array(held), n)]
        own = _small_model()
        lm.learn(own, kept, n[~np.array(held)], seed=len(kept), **how)
        met = np.bincount(kept, minlength=len(m.share)).astype(float)
        w = dict.fromkeys(lm.VECTORS, met) | {"out": met + 3.0 * len(kept) * m.share, "groups": np.bincount(m.group, met) + 3.0 * len(kept) * m.of_group}
        for k in lm.VECTORS:
            change[k] = change[k] + w[k][:, None] * (getattr(own, k) - getattr(m, k))
            weight[k] = weight[k] + w[k][:, None]
    for k in lm.VECTORS:
        np.testing.assert_allclose(getattr(got, k), getattr(m, k) + change[k] / np.maximum(weight[k], 1e-9), atol=3e-5)


def test_lm_beats_the_base_on_held_out_text(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    held = lm.score_documents(docs).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert held["s"] - held["b"] > 0.1 * held["n"]


def test_classifier_on_held_out_labels(spark, sf_small):
    docs, labels = spark.read.parquet(f"{sf_small}/documents.parquet"), spark.read.parquet(f"{sf_small}/labels.parquet")
    got = classifier.quality_scores(docs, labels)
    assert got.count() == docs.count() and got.where("score < 0 or score > 1 or score is null").count() == 0
    known = got.where("held_out").join(labels, "doc_id")
    good = known.where("(quality = 1) = (predicted = 1)").count()
    assert good >= 0.9 * known.count()
    rows = got.collect()
    assert all(r["held_out"] == (_held(r["doc_id"], 5) == 0) and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_classifier_cases(spark):
    docs = spark.createDataFrame([(i, "good plain words here" if i % 2 else "### ### $$$") for i in range(40)] + [(41, None), (42, ""), (None, "good plain"), (1, "good plain words here")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(99, 1, 0), (None, 1, 0), (2, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = classifier.quality_scores(docs.withColumn("label", F.lit(7)), labels).collect()
    assert len(got) == 44 and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] > 0.5) == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] is not None and r["doc_id"] < 40)
    assert {r["score"] for r in classifier.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert classifier.quality_scores(docs.limit(0), labels).count() == 0


def test_neighbour_votes_equal_brute_force():
    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(size=(60, classifier.FEATURES))).astype(np.float32)
    y = rng.integers(0, 2, 60).astype(np.float32)
    m = classifier.fit(x, y, 16, 5, 2.0, 0.5)
    z = classifier._latent(x[:10] + 0.1, m.mean, m.axes)
    for a, got in zip(z, classifier.votes(m, z), strict=True):
        cos = m.vectors @ a
        near = np.argsort(-cos)[:5]
        w = np.maximum(cos[near], 0).astype(np.float64) ** 2 + 1e-9
        assert got == pytest.approx((w * y[near]).sum() / w.sum(), abs=1e-6)


PAGES = "page_id long, url string, html string"


def _pages(spark):
    big = "<p>" + "text " * 50 + "é</p>"
    rows = [(5, "http://a/x y", big), (2, "http://b", big), (9, None, big), (1, "http://c", "short"), (3, "http://d", "short"), (4, "http://e", None), (6, "http://f", ""),
            (None, "http://g", big), (2, "http://b", big), (7, "http://h", "\r\n\r\n" * 40)]
    return spark.createDataFrame(rows, PAGES).withColumns({"digest": F.lit("x"), "payload": F.lit(1), "first": F.lit(0)})


def test_archives_round_trip(spark):
    pages = _pages(spark)
    index = warc.write_archives(pages, file_bytes=300)
    assert index.select("file").distinct().count() > 1
    got = warc.read_records(index).collect()
    assert len(got) == 10
    rows = sorted((str(r["page_id"]), r["record_type"], str(r["refers_to"]), r["payload_bytes"]) for r in got)
    n = len(("<p>" + "text " * 50 + "é</p>").encode())
    assert rows == sorted([("5", "revisit", "2", n), ("2", "response", "None", n), ("2", "response", "None", n), ("9", "revisit", "2", n), ("None", "revisit", "2", n), ("1", "response", "None", 5),
                           ("3", "response", "None", 5), ("4", "response", "None", 0), ("6", "response", "None", 0), ("7", "response", "None", 160)])
    html = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert all(bytes(r["payload"]) == html[r["page_id"]] for r in got if r["record_type"] == "response")
    some = warc.read_records(index.where("page_id in (1, 7)"), gap=0, read_bytes=64).collect()
    assert {r["page_id"] for r in some} == {1, 7}
    assert warc.read_records(warc.write_archives(pages.limit(0))).count() == 0


def test_archives_are_plain_gzip_members(spark):
    index = warc.write_archives(_pages(spark).where("page_id = 5")).first()
    fs, path = warc.file_system(index["file"])
    data = fs.open_input_file(path).read()
    assert index["offset"] == 0 and index["length"] == len(data)
    text = zlib.decompress(data, 31)
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"WARC-Target-URI: http://a/x%20y\r\n" in text and text.endswith(b"\r\n\r\n")
    with pytest.raises(ValueError, match="differs"):
        warc.parse_record(text.replace(b"text text", b"text texT", 1))


def test_ranges_are_joined():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 40, 5), ("b", 45, 5), ("b", 50, 100)]
    assert list(warc.coalesced(rows, 10, 60)) == [("a", 0, 15, [0, 1]), ("a", 40, 45, [2]), ("b", 45, 50, [3]), ("b", 50, 150, [4])]


@pytest.mark.parametrize("name", ["op3_lm_scores", "op8_quality_classifier", "op9_decontaminate", "op11_phrases", "op12_lexical_search", "op13_html_extraction"])
def test_what_is_broadcast_needs_no_package_on_the_executors(spark, sf_small, monkeypatch, name):
    import pickle

    from pyspark import SparkContext

    from demand_engine.llm import queries

    sent = []
    plain = SparkContext.broadcast
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sent.append(pickle.dumps(value)) or plain(self, value))
    queries.QUERIES[name](spark, sf_small).limit(1).collect()
    assert sent and not any(b"demand_engine" in x for x in sent)
