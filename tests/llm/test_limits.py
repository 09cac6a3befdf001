"""What the operators leave on disk and take in memory."""

import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from demand_engine.llm import linededup, lm, phrases
from demand_engine.llm import textops as tx
from demand_engine.session import shuffles_dropped


def _peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_lookup_equals_indexing():
    buf = np.random.default_rng(1).integers(0, 256, 1 << 16).astype(np.uint8)
    for table in (tx.LOWER, tx.SPACED, phrases.BREAK):
        got = tx.lookup(table, buf)
        assert got.dtype == table.dtype
        np.testing.assert_array_equal(got, table[buf])
    assert len(tx.lookup(tx.SPACED, buf[:0])) == 0


class _Docs:
    """Keeps the function that a task would run."""

    def __init__(self, spark):
        self.sparkSession = spark

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def groupBy(self, *columns):
        return self

    def agg(self, *columns):
        return self


def test_phrases_of_a_piece_come_in_batches(spark):
    words = [f"w{i}" for i in range(150_000)]
    docs = _Docs(spark)
    phrases.counted(docs, [1, 2])
    piece = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([" ".join(words)])], ["lang", "text"])
    sizes, rows = [], []
    for batch in docs.run(iter([piece])):
        sizes.append(batch.num_rows)
        rows += zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase", "n")), strict=True)
    assert max(sizes) <= 1 << 16
    assert sorted(rows) == sorted([("en", x, 1) for x in [*words, *map(" ".join, zip(words, words[1:], strict=False))]] + [("en", "", len(words))])


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_line_dedup_leaves_no_shuffle_of_the_texts(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    rows = [(i, f"own line {i}\nthe same\npassage here\nend {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).localCheckpoint()
    before, was = _shuffle_files(spark), spark.conf.get(setting, None)
    _, cuts = linededup.repeated_chunks(docs, "doc_id", "text")
    until = time.monotonic() + 20
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(setting, None) == was
    assert cuts.count() == 199  # all but the first are cut


def test_shuffles_dropped_restores_the_setting(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(setting, "false")
    try:
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
            assert spark.conf.get(setting) == "true"
            raise ZeroDivisionError
        assert spark.conf.get(setting) == "false"
    finally:
        spark.conf.unset(setting)


def test_contrast_holds_one_matrix_of_odds():
    draw = np.random.default_rng(2)
    n, draws, width = 2048, 512, 4
    h, table = (draw.normal(0, 1, (x, width)).astype(np.float32) for x in (n, 900))
    h[:, -1] = 1
    target, drawn = draw.integers(0, 900, n), draw.integers(0, 900, draws)
    shift = draw.normal(0, 1, 900).astype(np.float32)
    got = []
    peak = _peak(lambda: got.extend(lm.contrast(h, table, target, drawn, shift, 3.0)))
    assert peak < 1.6 * 4 * n * draws
    odds = 1 / (1 + np.exp(shift[drawn] - h.astype(float) @ table[drawn].T)) * 3 / draws
    up = 1 / (1 + np.exp(shift[target] - (h.astype(float) * table[target]).sum(1))) - 1
    np.testing.assert_allclose(got[0], up[:, None] * table[target] + odds @ table[drawn], atol=1e-4)
    assert got[1].tolist() == [*target, *drawn]
    np.testing.assert_allclose(got[2], np.concatenate((up[:, None] * h, odds.T @ h)), atol=1e-4)
