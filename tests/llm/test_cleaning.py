"""Quality rules, line dedup, decontamination and byte-window dedup against brute force."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from demand_engine.llm import decontaminate, linededup, quality_rules, suffixes

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def documents(spark, rows, extra=False):
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    if extra:  # names that the operators use inside
        df = df.withColumns({"id": F.lit("x"), "th": F.lit("y"), "kept": F.lit("z"), "row": F.lit(1), "cuts": F.lit(2), "token": F.lit(3)})
    return df


CLEAN = "\n".join(f"The clear sentence{i} number says{i} plain things{i} about the{i} day." for i in range(12))
NAV = "\n".join(f"home{i} | about{i} | contact{i} | news{i} | shop{i} | help{i}." for i in range(40))
SHOUT = " ".join(f"WORD{chr(65 + i)}!!" for i in range(20)) + "\n" + " ".join(f"OTHER{chr(65 + i)}!!" for i in range(25)) + " AND MORE WORDS!! HERE!! NOW!! SO!! IT!! IS!!"
MARKS = " ".join(f"w{i}***" for i in range(60))


def test_quality_rules_verdicts_and_text(spark):
    rows = [(1, CLEAN), (2, NAV), (3, SHOUT), (4, MARKS), (5, None), (6, ""), (7, CLEAN + "\nAll rights reserved."), (7, CLEAN + "\nAll rights reserved."),
            (None, CLEAN), (9, "a b " * 40), (10, CLEAN + "\n" + NAV)]
    df = documents(spark, rows, extra=True)
    got = quality_rules.judge_documents(df, with_text=True).collect()
    kept = sorted((r["doc_id"] for r in got if r["kept"]), key=str)
    assert kept == [1, 7, 7, None]
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[7]["cleaned"] == CLEAN and by_id[7]["n_boilerplate"] == 1
    assert by_id[5]["base_failed"] and by_id[5]["n_words"] == 0
    assert by_id[9]["base_failed"] and by_id[9]["n_repeat_words"] == 80
    assert not by_id[10]["base_failed"] and by_id[10]["n_navigation"] == 40
    out = quality_rules.clean_documents(df)
    assert out.dtypes == df.dtypes and out.count() == 4
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
    assert quality_rules.judge_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_quality_counts_against_plain_python(spark, seed):
    rnd = random.Random(seed)
    rows = [(i, "".join(rnd.choice(["ab ", "é#", "x", "\n", "\t", "|", "ab ab ", "\x0b", "ü "]) for _ in range(rnd.randrange(200)))) for i in range(60)]
    got = {r["doc_id"]: r for r in quality_rules.judge_documents(documents(spark, rows)).collect()}
    for i, t in rows:
        w = SPACED.findall(t)
        tri = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        hit = {p for k, x in enumerate(tri) if tri.count(x) > 1 for p in (k, k + 1, k + 2)}
        lines = [x for x in t.split("\n") if SPACED.search(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))
        assert tuple(got[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == expected


def _line_rows(seed, n=60):
    rnd = random.Random(seed)
    shared = ["\n".join(f"shared {p} line {k} of text" for k in range(rnd.randrange(2, 9))) for p in range(5)]
    rows = []
    for i in range(n):
        parts = [rnd.choice(shared) if rnd.random() < 0.5 else f"own {i} {k} {rnd.random()}" for k in range(rnd.randrange(6))]
        rows.append((rnd.choice([i, i, i, None]), rnd.choice(["\n".join(parts), "\n".join(parts), None, ""])))
    return rows + rows[:3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_against_brute_force(spark, seed):
    rows = _line_rows(seed)
    df = documents(spark, rows, extra=True)
    place = lambda i, t, k: (i is None, i or 0, linededup_hash(spark, t), k)
    keeper, spans = {}, {}
    for i, t in set(rows):
        data = (t or "").encode()
        spans[t] = linededup.chunk_spans(data)
        for k, (a, b, _) in enumerate(spans[t]):
            keeper[data[a:b]] = min(keeper.get(data[a:b], place(i, t, k)), place(i, t, k))
    expected = []
    for i, t in rows:
        data, out, at = (t or "").encode(), b"", 0
        for k, (a, b, _) in enumerate(spans[t]):
            if keeper[data[a:b]] != place(i, t, k):
                out, at = out + data[at:a], b + 1
        expected.append((str(i), hashlib.sha256(out + data[at:]).hexdigest()))
    got = [(str(r["doc_id"]), r["kept_sha256"]) for r in linededup.dedup_report(df).collect()]
    assert sorted(got) == sorted(expected)
    out = linededup.dedup_lines(df)
    assert out.dtypes == df.dtypes and out.count() <= len(rows)
    assert linededup.dedup_lines(df.limit(0)).count() == 0


def linededup_hash(spark, text, seen={}):  # noqa: B006
    if text not in seen:
        seen[text] = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0]
    return seen[text]


@pytest.mark.parametrize("n", [2, 3, 5, 10])
def test_line_dedup_finds_short_passages(spark, n):
    rnd = random.Random(n)
    own = lambda: [f"own {rnd.random()} of its document" for _ in range(rnd.randrange(1, 12))]
    rows, expected = [], {}
    for p in range(15):
        passage = [f"passage {n} {p} line {k} {rnd.random()}" for k in range(n)]
        if p % 3 == 0:
            passage.insert(1, "")  # blank lines go with the passage
        for i in (2 * p, 2 * p + 1):
            before, after = own(), [*own(), "a line found everywhere", *own()]  # which stays: it repeats alone
            rows.append((i, "\n".join(before + passage + after)))
            expected[i] = (i % 2, len(passage) * (i % 2), hashlib.sha256("\n".join(before + passage * (1 - i % 2) + after).encode()).hexdigest())
    got = linededup.dedup_report(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_removed_chunks"], r["n_removed_lines"], r["kept_sha256"]) for r in got} == expected


def test_line_dedup_of_repeating_lines_within_a_document(spark):
    rows = [(1, "x\nx\nx"), (2, "y\ny\ny\ny\ny"), (3, "a\nb\na\nb\na\nb"), (4, "p\nq\nr"), (5, "q\nr\nend"), (6, "p\n\nq")]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: "x\nx\nx", 2: "y\ny\n", 3: "a\nb\n", 4: "p\nq\nr", 5: "end", 6: "p\n\nq"}


def _needles(items, n=13):
    out = {}
    for i, t in items:
        w = ALNUM.findall(lower(t))
        k = min(n, len(w))
        for s in range(len(w) - k + 1 if k else 0):
            out.setdefault(tuple(w[s : s + k]), set()).add(str(i))
    return out


def test_decontamination_against_brute_force(spark):
    rnd = random.Random(4)
    word = lambda: rnd.choice(["the", "Of", "x1", "élan", "b"])
    items = [(10, " ".join(word() for _ in range(16))), (9, "Two, words"), (2, None), (3, ""), (4, " ".join(f"r{i}" for i in range(20))), (5, "r3 r4 r5 r6 r7")]
    items.append((11, items[0][1]))
    rows = []
    for i in range(80):
        parts = [word() for _ in range(rnd.randrange(60))]
        if rnd.random() < 0.6:
            parts[5:5] = (rnd.choice(items)[1] or "").split()[rnd.randrange(2) :]
        rows.append((rnd.choice([i, None]), rnd.choice([" ".join(parts), "-".join(parts), None])))
    rows += rows[:4]
    df = documents(spark, rows, extra=True)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("token", F.lit("clash"))
    needles = _needles(items)
    expected = []
    for i, t in rows:
        w = ALNUM.findall(lower(t))
        hit, found = set(), set()
        for n in {len(x) for x in needles}:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in needles:
                    hit |= set(range(s, s + n))
                    found |= needles[tuple(w[s : s + n])]
        expected.append((str(i), len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = [(str(r["doc_id"]), *(r[c] for c in columns)) for r in decontaminate.contaminated_documents(df, bench).collect()]
    assert sorted(got) == sorted(expected)
    clean = decontaminate.clean_documents(df, bench)
    assert clean.dtypes == df.dtypes and clean.count() == sum(not x[-1] for x in expected)
    assert decontaminate.contaminated_documents(df.limit(0), bench).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contaminated_documents(df, bench.limit(0)).collect())


def test_decontamination_by_share_of_shingles(spark):
    item = [f"w{i}" for i in range(13)]
    near = [*item[:12], "other"]  # 8 of 9 shingles
    far = [*item[:6], "a", "b", *item[8:]]
    df = documents(spark, [(1, " ".join(["x"] * 3 + near)), (2, " ".join(far)), (3, " ".join(item))])
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["contaminated"] for r in decontaminate.contaminated_documents(df, bench, containment=0.8).collect()}
    assert got == {1: True, 2: False, 3: True}


def _brute_windows(rows, depth):
    first, out = {}, []
    rank = lambda i: float("inf") if i is None else i
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - depth + 1):
            first[b[p : p + depth]] = min(first.get(b[p : p + depth], rank(i)), rank(i))
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - depth + 1):
            if first[b[p : p + depth]] < rank(i):
                gone[p : p + depth] = b"\1" * depth
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((str(i), len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("depth", "bucket_bytes"), [(50, 1 << 24), (12, 1 << 24), (20, 600)])
def test_suffix_dedup_against_brute_force(spark, depth, bucket_bytes):
    rnd = random.Random(depth)
    base = ["ab" * 60, "x" * 200, "".join(rnd.choice("abc ") for _ in range(400)), "", None, "é" * 80]
    rows = []
    for i in range(120):
        parts = [(rnd.choice([rnd.choice(base) or "", "".join(rnd.choice("ab") for _ in range(rnd.randrange(90)))]))[rnd.randrange(30) : rnd.randrange(30, 200)] for _ in range(rnd.randrange(5))]
        rows.append((rnd.choice([i, i, i, i - 1, None]), "".join(parts) if i % 17 else None))
    df = documents(spark, rows, extra=True)
    got = suffixes.remove_repeats(df, depth=depth, bucket_bytes=bucket_bytes, with_text=True).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == _brute_windows(rows, depth)
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in got)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


def test_suffix_dedup_of_long_and_many_copies(spark):
    text = " ".join(f"tok{i}" for i in range(30_000))
    rows = [(i, text) for i in range(5)] + [(9, text[: len(text) // 2]), (10, "new " + text[100:400] + " new")]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffixes.remove_repeats(documents(spark, rows)).collect()}
    n = len(text)
    assert got == {0: (n, 0, 0), **{i: (n, n, 1) for i in range(1, 5)}, 9: (n // 2, n // 2, 1), 10: (308, 300, 1)}


@pytest.mark.parametrize("unit", ["-", "=-", "<p> ", "".join(chr(97 + i % 26) + str(i) for i in range(24))])
def test_suffix_dedup_of_periodic_runs(spark, unit):
    run = lambda n: (unit * (n // len(unit) + 1))[:n]
    rows = [(1, "one " + run(60) + " begins"), (2, "two " + run(1000) + " goes on"), (3, run(300)), (4, "4" + run(75) + "x" + run(500))]
    for docs in (rows, rows + [(2, rows[1][1])], rows[1:]):
        got = suffixes.remove_repeats(documents(spark, docs)).collect()
        assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == _brute_windows(docs, 50)


def test_suffix_dedup_of_a_passage_with_many_continuations(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", 20, raising=False)
    rnd = random.Random(5)
    some = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, far = some(150), some(65)
    rows = [(i, some(rnd.randrange(60)) + passage + some(rnd.randrange(60)) + (far + "-") * (i % 4)) for i in range(200)]
    rows += [(7, rows[7][1]), (None, rows[3][1] + "z"), (300, "=" * 60)] + [(301 + i, "=" * (60 + 9 * i) + some(9)) for i in range(30)]
    sizes, inner = [], suffixes.last_digits

    def spy(texts, contexts, *rest):
        first = suffixes._unpack([r["blob"] for r in contexts.collect()], suffixes._SUFFIXES)["first"].tolist()
        sizes.append(max((first.count(x) for x in set(first)), default=0))
        return inner(texts, contexts, *rest)

    monkeypatch.setattr(suffixes, "last_digits", spy)
    got = suffixes.remove_repeats(documents(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == _brute_windows(rows, 50)
    assert sizes[0] <= 20  # contexts of an anchor that meet in one task
