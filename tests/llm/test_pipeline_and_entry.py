"""The corpus pipeline stage by stage, the registration, and the SQL of the numbered queries."""

import os
import random
import re
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from demand_engine.llm.queries import ORACLE_SQL, QUERIES
from demand_engine.llm.scratch import materialise, table_scope
from demand_engine.session import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registration():
    import __spark_entry__ as se

    found = se.queries()
    numbers = sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES)
    assert numbers == list(range(1, 14)) and set(QUERIES) <= set(found) and found["pipeline"] is corpus_pipeline.run
    assert set(ORACLE_SQL) <= set(QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "mixing"]


@pytest.mark.parametrize("hidden", ["xxhash", "zstandard"])
def test_entry_without_a_library_of_the_subpackage(hidden):
    """The other queries stay where the subpackage cannot be imported."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = f"import sys; sys.modules[{hidden!r}] = None; import __spark_entry__ as se; q = se.queries(); print('FOUND', len(q), any(k.startswith('op') for k in q), len(se.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, cwd=root, timeout=120)
    assert out.returncode == 0, out.stderr[-1000:]
    n, numbered, sql = out.stdout.split("FOUND ")[1].split()
    assert int(n) >= 82 and numbered == "False" and int(sql) >= 74


def test_pipeline_stages_narrow_the_documents(spark, sf_small):
    docs = before = spark.read.parquet(f"{sf_small}/documents.parquet")
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_small), name)
        counts.append(docs.count())
        assert docs.columns == COLUMNS + ["mix_repeats"] * (name == "mixing")
        assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0
    run = corpus_pipeline.run(spark, sf_small)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))


def _plain_quality(docs):
    """On these texts: boilerplate and navigation lines go, and documents of
    under 50 words or that lose over half."""
    out = {}
    for i, (t, s) in docs.items():
        kept = "\n".join(x for x in (t or "").split("\n") if "rights reserved" not in x and " | " not in x)
        if len((t or "").split()) >= 50 and 2 * len(kept) >= len(t):
            out[i] = (kept, s)
    return out


def _plain_lines(docs):
    """Lines in a pair of neighbours that an earlier document has go."""
    seen, out = set(), {}
    for i, (t, s) in sorted(docs.items()):
        lines = t.split("\n")
        pairs = list(zip(lines, lines[1:], strict=False))
        gone = {p for k, x in enumerate(pairs) if x in seen for p in (k, k + 1)}
        seen |= set(pairs)
        kept = "".join(x + "\n" * (k + 1 < len(lines)) for k, x in enumerate(lines) if k not in gone)
        if kept.split():
            out[i] = (kept, s)
    return out


def _plain_near(docs):
    """The smallest id of each group linked at 0.8 of 5-word shingles stays."""
    words = {i: t.lower().split() for i, (t, _) in docs.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    root = {i: i for i in docs}
    for a in docs:
        for b in docs:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    return {i: x for i, x in docs.items() if root[i] == i}


def _plain_clean(docs, item):
    """Documents of which a twentieth lies in 13 words of the item go."""
    words = lambda t: re.findall("[a-z0-9]+", t.lower())
    w = words(item)
    needles = {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    out = {}
    for i, (t, s) in docs.items():
        w = words(t)
        hit = {p for k in range(len(w) - 12) if tuple(w[k : k + 13]) in needles for p in range(k, k + 13)}
        if not hit or 20 * len(hit) < len(w):
            out[i] = (t, s)
    return out


def _plain_mix(docs, h):
    """How often each document is taken: by hash, up to its source's target."""
    size = {i: len(t.split()) for i, (t, _) in docs.items()}
    names = sorted({s for _, s in docs.values()})
    own = {s: sum(size[i] for i, x in docs.items() if x[1] == s) for s in names}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        level = (sum(own.values()) - sum(3 * own[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 3 * own[s]}
        if not more:
            break
        full |= more
    out = {}
    for s in names:
        target = min(weight[s] * level, 3 * own[s])
        times = int(target // own[s])
        rest, below = target - times * own[s], 0
        for i in sorted((i for i in docs if docs[i][1] == s), key=h.get):
            # the document in which the budget ends counts if over half of it fits
            once_more = below + size[i] <= rest or 0 < 2 * (rest - below) > size[i]
            below += size[i]
            if times + once_more:
                out[i] = times + once_more
    return out


def test_pipeline_of_planted_documents_against_plain_python(spark, tmp_path):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghiklmnoprstu") for _ in range(7))
    say = lambda: f"The {word()} {word()} says plain {word()} {word()} about the {word()} day."
    item = " ".join(word() for _ in range(20))
    docs, passage = {}, [say() for _ in range(3)]
    for i in range(40):
        lines = [say() for _ in range(rnd.randrange(9, 16))]
        if i % 8 == 1:
            lines[4:4] = passage  # the first one keeps it
        if i % 8 == 2:
            lines.insert(3, "All rights reserved.")
        if i % 8 == 3:
            lines[2:2] = [f"It is known that {item} is so."]
        docs[i] = ("\n".join(lines), "abc"[i % 3])
        if i % 8 == 4:  # near copy in other lines
            copy = [*lines[:-1], say()]
            docs[100 + i] = ("\n".join(" ".join(copy[k : k + 2]) for k in range(0, len(copy), 2)), "b")
    docs |= {200: (None, "a"), 201: ("", "b"), 202: (say(), "c"), 203: ("\n".join(f"home{k} | about{k} | contact{k} | news{k} | shop{k} | help{k}." for k in range(40)), "a")}
    rows = [(i, t, "en", s, len(t or "")) for i, (t, s) in docs.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for plain in (_plain_quality, _plain_lines, _plain_near, lambda x: _plain_clean(x, item)):
        before, docs = docs, plain(docs)
        assert docs != before  # each stage has something to do
    left = spark.createDataFrame([(i, t) for i, (t, _) in docs.items()], "doc_id long, text string")
    h = {r["doc_id"]: r["h"] for r in left.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    taken = _plain_mix(docs, h)
    got = {r["doc_id"]: (r["text"], r["source"], r["mix_repeats"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: (*docs[i], n) for i, n in taken.items()}


def test_pipeline_of_an_empty_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small)
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_equal_their_sql(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = QUERIES[name](spark, sf_small)
    res = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((str(tuple(r[c] for c in names)) for r in df.collect())) == sorted(str(tuple(r)) for r in res.fetchall())


def _tables(spark):
    folder = shared_path(spark, "tables").removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_the_run_and_op2_leave_their_result_only(spark, sf_small):
    for make, name in ((corpus_pipeline.run, "mixing"), (QUERIES["op2_near_duplicates"], "near-duplicates")):
        before = _tables(spark)
        with table_scope(spark):
            assert make(spark, sf_small).count()
            assert [x.rsplit("-", 1)[0] for x in _tables(spark) - before] == [name]
        assert _tables(spark) == before
