"""Leaf-wise boosting: against a plain numpy version, over tasks, jobs and layouts."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from demand_engine.config import LeafTreeParams
from demand_engine.operators import boosting as bo
from demand_engine.operators.boosting import LeafTreesForecaster


def _plain_tree(x, cuts, q, features, leaves, least):
    """Best-first growth as a loop over all leaves, features and cuts, each
    split judged from the rows themselves."""

    def look(rows):
        best, total = None, q[rows].sum()
        for f in features:
            values = x[f][rows]
            for b, cut in enumerate(cuts[f]):
                left = values <= cut
                nl = int(left.sum())
                nr = len(rows) - nl
                if nl >= least and nr >= least:
                    gl = q[rows][left].sum()
                    gain = gl * gl / nl + (total - gl) * (total - gl) / nr - total * total / len(rows)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, b)
        return best

    front = [((), np.arange(len(q)))]
    seen = {(): look(front[0][1])}
    nodes = {(): [0, -1, None]}
    while len(front) < leaves:
        able = [(path, rows) for path, rows in front if seen[path]]
        if not able:
            break
        path, rows = min(able, key=lambda a: (-seen[a[0]][0], a[0]))
        _, f, b = seen[path]
        left = x[f][rows] <= cuts[f][b]
        front = [a for a in front if a[0] != path]
        nodes[path][1:] = [f, cuts[f][b]]
        for i, own in enumerate((rows[left], rows[~left])):
            front.append(((*path, i), own))
            seen[*path, i] = look(own)
            nodes[*path, i] = [len(nodes), -1, None]
    return nodes, front


def _plain_boost(x, y, is_val, p, rounds):
    """Trees as (node, feature, threshold or value) rows, and losses."""
    train, val = np.flatnonzero(~is_val), np.flatnonzero(is_val)
    cuts = [bo.cut_points(v[train], p.max_bins) for v in x]
    n = len(train)
    step = bo.step_for(n, np.abs(y[train]).max())
    start = np.rint(y[train] * step).sum() / step / n
    apart = np.abs(y - start).max()
    step = bo.step_for(n, bo.HEADROOM * apart)
    margin, out, losses = np.full(len(y), start), [], []
    for t in range(rounds):
        features = bo.drawn_features(len(x), p.colsample_bytree, p.seed, t)
        nodes, front = _plain_tree([v[train] for v in x], cuts, np.rint((y - margin)[train] * step), features, p.num_leaves, p.min_child_samples)
        q = np.rint((y - margin)[train] * step)
        value = {path: p.learning_rate * (q[rows].sum() / len(rows) / step) for path, rows in front}
        out.append(sorted((num, f, cut if f >= 0 else value[path]) for path, (num, f, cut) in nodes.items()))
        for i in range(len(y)):
            path = ()
            while nodes[path][1] >= 0:
                path = (*path, int(x[nodes[path][1]][i] > nodes[path][2]))
            margin[i] += value[path]
        losses.append(((y[val] - margin[val]) ** 2).mean())
    return start, out, losses


def _panel(n, seed=3):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=n), rng.integers(0, 5, n).astype(float), rng.exponential(size=n).round(2), rng.normal(size=n)]
    y = 1000 + 300 * x[0] * (x[1] > 2) + 80 * x[2] - 50 * x[3] ** 2 + rng.normal(size=n) * 20
    return x, y


def _shaped(nodes):
    return [(x["node"], x["feature"], x["threshold"] if x["left"] >= 0 else x["value"]) for x in nodes]


@pytest.mark.parametrize(("n", "leaves", "bins", "rounds"), [(3_000, 31, 20, 3), (50_000, 12, 12, 2), (200, 31, 255, 3)])
def test_learner_equals_a_plain_version(n, leaves, bins, rounds):
    x, y = _panel(n)
    is_val = np.arange(n) % 10 == 0
    p = LeafTreeParams(num_leaves=leaves, max_bins=bins, learning_rate=0.3, colsample_bytree=0.7)
    cuts = [bo.cut_points(v[~is_val], bins) for v in x]
    got = list(bo.boost(bo.binned(x, cuts), y, is_val, cuts, [], [], rounds, p, lambda own: [own]))
    start, trees, losses = _plain_boost(x, y, is_val, p, rounds)
    assert got[0][0]["value"] == start and len(got) == rounds + 1
    for own, want, loss in zip(got[1:], trees, losses, strict=True):
        assert _shaped(own) == want
        assert own[0]["loss"] == pytest.approx(loss, rel=1e-9)


def _frame(spark, n, seed=3):
    x, y = _panel(n, seed)
    rows = [(int(i % 40), int(i // 40), float(y[i]), *(float(v[i]) for v in x)) for i in range(n)]
    df = spark.createDataFrame(rows, "Store long, week int, Weekly_Sales double, a double, b double, c double, d double")
    return df.withColumn("Date", F.date_add(F.lit("2020-01-06").cast("date"), F.col("week") * 7)).drop("week")


def _trees(m):
    return [(x["tree"], *s) for x, s in zip(m.nodes, _shaped(m.nodes), strict=True)]


def test_trees_do_not_depend_on_tasks_layout_or_jobs(spark):
    df = _frame(spark, 4_000)
    p = dict(n_estimators=4, num_leaves=8, learning_rate=0.4, early_stopping_rounds=10)
    feats = ["a", "b", "c", "d", "absent"]
    one = LeafTreesForecaster(LeafTreeParams(**p), feats).fit(df)
    assert one.features == feats[:4] and one.n_trees == 4 and one.rounds_fitted == 4
    shared = LeafTreesForecaster(LeafTreeParams(**p, rows_per_task=1_500), feats).fit(df.repartition(7))  # three tasks swap histograms
    jobs = LeafTreesForecaster(LeafTreeParams(**p, rounds_per_job=3), feats).fit(df.repartition(3, "b"))  # two jobs
    for other in (shared, jobs):
        assert _trees(other) == _trees(one) and other.start == one.start
        assert other.validation_losses == one.validation_losses and other.rounds_fitted == 4


SCRIPT = """
import hashlib, sys
sys.path.insert(0, {tests!r})
from test_boosting import _frame, _trees
from demand_engine.config import LeafTreeParams
from demand_engine.operators.boosting import LeafTreesForecaster
from demand_engine.session import get_spark
spark = get_spark(sys.argv[1], shuffle_partitions=4)
m = LeafTreesForecaster(LeafTreeParams(n_estimators=3, num_leaves=6, rows_per_task=600), ["a", "b", "c", "d"]).fit(_frame(spark, 2_400))
print("RESULT", hashlib.sha256(repr((m.start, _trees(m), m.validation_losses)).encode()).hexdigest())
"""


def test_trees_do_not_depend_on_the_cores():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = set()
    for master in ("local[2]", "local[4]"):  # as many tasks swap
        script = SCRIPT.format(tests=os.path.dirname(os.path.abspath(__file__)))
        out = subprocess.run([sys.executable, "-c", script, master], env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, timeout=600, cwd=root)
        assert out.returncode == 0, out.stderr[-2000:]
        found.add(out.stdout.split("RESULT ")[1].strip())
    assert len(found) == 1


def test_patience_ends_a_fit_and_no_round_is_fitted_twice(spark):
    df = _frame(spark, 2_000).withColumn("Weekly_Sales", F.col("Weekly_Sales") + F.when(F.col("Date") > "2020-11-01", F.rand(4) * 4_000).otherwise(0))
    p = dict(learning_rate=0.8, early_stopping_rounds=3, num_leaves=31, min_child_samples=5)
    m = LeafTreesForecaster(LeafTreeParams(**p), ["a", "b", "c", "d"]).fit(df)
    losses = m.validation_losses
    assert m.n_trees == 1 + int(np.argmin(losses)) and len(losses) == m.n_trees + 3 == m.rounds_fitted
    few = LeafTreesForecaster(LeafTreeParams(**p, rounds_per_job=2), ["a", "b", "c", "d"]).fit(df)
    assert _trees(few) == _trees(m) and few.rounds_fitted == m.rounds_fitted


def test_predictions_and_importances_follow_the_node_table(spark):
    df = _frame(spark, 1_500)
    m = LeafTreesForecaster(LeafTreeParams(n_estimators=5, num_leaves=7, learning_rate=0.5), ["a", "b", "c", "d"]).fit(df)
    by = {}
    for r in m.node_table(spark).collect():
        by.setdefault(r["tree"], {})[r["node"]] = r
    assert len(by) == m.n_trees and all(len(t) == 13 for t in by.values())
    scored = df.union(df.limit(1).withColumn("a", F.lit(None).cast("double")))
    for r in m.predict(scored).limit(300).collect() + m.predict(scored).where("a is null").collect():
        total = m.start
        for t in range(m.n_trees):
            node = by[t][0]
            while node["left"] >= 0:
                node = by[t][node["left"] if (r[node["feature"]] or 0.0) <= node["threshold"] else node["right"]]
            total += node["value"]
        assert r[m.output_col] == pytest.approx(max(total, 0.0), rel=1e-12)
    gains = {}
    for t in by.values():
        for x in t.values():
            if x["left"] >= 0:
                g, n = gains.get(x["feature"], (0.0, 0))
                gains[x["feature"]] = (g + x["gain"], n + 1)
    total = sum(g for g, _ in gains.values())
    got = [tuple(r) for r in m.feature_importances_df(spark).collect()]
    assert [x[0] for x in got] == [x[0] for x in m.feature_importances()] and len(got) == 4
    for f, share, n in got:
        assert share == pytest.approx(gains.get(f, (0, 0))[0] / total) and n == gains.get(f, (0, 0))[1]


def test_odd_training_tables(spark):
    df = _frame(spark, 300)
    flat = LeafTreesForecaster(features=["a"]).fit(df.withColumn("Weekly_Sales", F.lit(7.0)))
    assert flat.n_trees == 0 and {r[0] for r in flat.predict(df).select(flat.output_col).distinct().collect()} == {7.0}
    one = LeafTreesForecaster(features=["a"]).fit(df.limit(1))
    assert one.n_trees == 0 and math.isfinite(one.start)
    empty = LeafTreesForecaster(features=["a"]).fit(df.limit(0))
    assert empty.start == 0.0 and empty.feature_importances() == [("a", 0.0, 0)]
    deep = LeafTreesForecaster(LeafTreeParams(n_estimators=2, max_depth=2, num_leaves=31, min_child_samples=2), ["a", "b"]).fit(df)
    assert max(sum(1 for x in deep.nodes if x["tree"] == t) for t in (0, 1)) <= 7


def test_cut_points():
    assert bo.cut_points(np.array([3.0, 1.0, 3.0, 2.0]), 255).tolist() == [1.5, 2.5]
    assert bo.cut_points(np.array([4.0]), 255).tolist() == []
    cuts = bo.cut_points(np.arange(10_000.0), 16)
    sizes = np.bincount(np.searchsorted(cuts, np.arange(10_000.0)))
    assert len(cuts) == 15 and sizes.min() > 600 and sizes.max() < 650
    heavy = bo.cut_points(np.r_[np.zeros(9_000), np.arange(1.0, 1_001.0)], 16)
    assert 0 < heavy[0] < 1


def test_swaps_through_files_give_every_task_all_arrays_and_leave_few_files(tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from pyarrow import fs

    tasks, swaps, held = 3, 40, []

    def task(me):
        gather = bo._gather_by_files(fs.LocalFileSystem(), str(tmp_path), me, tasks)
        out = []
        for k in range(swaps):
            own = np.arange(6.0).reshape(2, 3) * (k + 1) + 100 * me if k % 3 else np.empty(0)
            out.append(gather(own))
            held.append(len(os.listdir(tmp_path)))
        return out

    with ThreadPoolExecutor(tasks) as pool:
        got = list(pool.map(task, range(tasks)))
    for k in range(swaps):
        want = [np.arange(6.0).reshape(2, 3) * (k + 1) + 100 * t if k % 3 else np.empty(0) for t in range(tasks)]
        for own in got:
            assert len(own[k]) == tasks and all(np.array_equal(a, b) for a, b in zip(own[k], want, strict=True))
    assert max(held) <= 2 * tasks and len(os.listdir(tmp_path)) == tasks


def test_swaps_cost_no_second_each(spark):
    """Three tasks swap some 100 times; a second each would pass the limit.
    The folder of the swaps goes with the fit."""
    import time

    from demand_engine.session import shared_path

    df = _frame(spark, 3_000)
    p = LeafTreeParams(n_estimators=25, num_leaves=8, early_stopping_rounds=25, rows_per_task=1_200)
    began = time.time()
    m = LeafTreesForecaster(p, ["a", "b", "c", "d"]).fit(df)
    assert m.rounds_fitted == 25 and time.time() - began < 45
    folder = shared_path(spark, "tables").removeprefix("file:")
    assert not [x for x in os.listdir(folder) if x.startswith(("swaps", "trees"))]


def test_a_shared_folder_that_arrow_cannot_open_leaves_the_barrier(spark):
    rows = spark.range(4).repartition(2)

    def run(batches):
        import pyarrow as pa
        from pyspark import BarrierTaskContext

        for _ in batches:
            pass
        gather = bo._gather_among(BarrierTaskContext.get(), 2, "nosuchscheme://x/y")
        yield pa.RecordBatch.from_pydict({"total": [float(sum(gather(np.array([2.0])))[0])]})

    assert [r[0] for r in rows.mapInArrow(run, "total double", barrier=True).collect()] == [4.0, 4.0]


def test_cut_points_come_from_all_rows_where_the_driver_cannot_take_them(spark):
    n, rng = 6_000, np.random.default_rng(5)
    cents = rng.integers(-300_000, 300_000, n) / 100
    x = [
        rng.normal(size=n) * 10.0 ** rng.integers(-8, 9, n),
        np.where(np.arange(n) % 7 < 4, 0.0, np.nextafter(cents, np.where(rng.random(n) < 0.5, np.inf, 0.0))),
        np.r_[np.full(n - 3, -0.0), 0.0, 4.5, -1e300],  # values of one row each
        rng.integers(0, 255, n).astype(float),
        rng.integers(0, 256, n) / 3,
        np.full(n, 7.25),
    ]
    columns = [f"x{i}" for i in range(len(x))]
    df = spark.createDataFrame([tuple(float(v[i]) for v in x) for i in range(n)], ", ".join(f"{c} double" for c in columns)).repartition(5)
    for rows in (1, 400, 20_000):
        for bins in (255, 16):
            got = bo.all_cut_points(df, columns, rows, n, bins)
            for own, v in zip(got, x, strict=True):
                np.testing.assert_array_equal(own, bo.cut_points(v, bins))


def test_a_fit_on_more_rows_than_the_driver_takes_misses_no_value(spark):
    """One row in two hundred has a value that a sample can miss; the split there is the best."""
    rows = [(i % 40, i // 40, float(i % 200 == 0), 50_000.0 if i % 200 == 0 else float(i % 3)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "Store long, week int, rare double, Weekly_Sales double")
    df = df.withColumn("Date", F.date_add(F.lit("2015-01-05").cast("date"), F.col("week") * 7)).drop("week")
    p = dict(n_estimators=2, num_leaves=2, learning_rate=0.5)
    some, every = (LeafTreesForecaster(LeafTreeParams(**p, bin_sample_rows=k), ["rare"]).fit(df) for k in (10, 100_000))
    assert _trees(some) == _trees(every) and (0, 0, 0, 0.5) in _trees(some)


MEMORY_SCRIPT = """
import os, threading, time
from pyspark.sql import functions as F
from demand_engine.config import LeafTreeParams
from demand_engine.operators.boosting import LeafTreesForecaster
from demand_engine.session import get_spark
spark = get_spark("local[2]", shuffle_partitions=2)
n = F.col("id")
df = spark.range(2_000_000).select((n % 10_000).alias("Store"), F.date_add(F.lit("2020-01-06").cast("date"), (n / 10_000).cast("int") * 7).alias("Date"),
    *[(F.xxhash64(n, F.lit(i)) % 1_000 / 8.0).alias(f"f{i}") for i in range(12)])
df = df.withColumn("Weekly_Sales", 1000 + F.col("f0") * 3 + F.when(F.col("f1") > 5, F.col("f2")).otherwise(-F.col("f3")))
most, go = [0], True

def watch():
    while go:
        parent, size = {}, {}
        for pid in filter(str.isdigit, os.listdir("/proc")):
            try:
                said = dict(x.split(":", 1) for x in open(f"/proc/{pid}/status").read().splitlines() if ":" in x)
            except OSError:
                continue
            if said["Name"].strip().startswith("python"):
                size[int(pid)] = int(said.get("VmRSS", "0 kB").split()[0]) // 1024
            parent[int(pid)] = int(said["PPid"])
        for pid in size:
            up = pid
            while up > 1 and up != os.getpid():
                up = parent.get(up, 0)
            if up == os.getpid() and pid != up:
                most[0] = max(most[0], size[pid])
        time.sleep(0.05)

seen = threading.Thread(target=watch)
seen.start()
m = LeafTreesForecaster(LeafTreeParams(n_estimators=2, num_leaves=8, rows_per_task=5_000_000), [f"f{i}" for i in range(12)]).fit(df)
go = False
seen.join()
print("RESULT", m.rounds_fitted, most[0])
"""


@pytest.mark.skipif(not os.path.exists("/proc/self/status"), reason="memory is read from /proc")
def test_a_task_holds_blocks_of_its_rows_only():
    """Two million rows in one task, which took 584 MB when it held them (168 now)."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", MEMORY_SCRIPT], env=os.environ | {"PYTHONPATH": root, "MALLOC_ARENA_MAX": "2"}, capture_output=True, text=True, timeout=600, cwd=root)
    assert out.returncode == 0, out.stderr[-2000:]
    rounds, most = (int(x) for x in out.stdout.split("RESULT ")[1].split())
    assert rounds == 2 and most < 300


def test_blocks_give_the_trees_of_rows_in_memory(monkeypatch):
    x, y = _panel(3_000)
    is_val = np.arange(3_000) % 10 == 0
    p = LeafTreeParams(num_leaves=31, max_bins=20, learning_rate=0.3, colsample_bytree=0.7)
    cuts = [bo.cut_points(v[~is_val], 20) for v in x]
    bins = bo.binned(x, cuts)
    whole = list(bo.boost(bins, y, is_val, cuts, [], [], 3, p, lambda own: [own]))
    monkeypatch.setattr(bo, "BLOCK_ROWS", 100)
    train, val = bo._Blocks(4, 31), bo._Blocks(4, 31)
    for a in range(0, 3_000, 37):
        own = np.arange(a, min(a + 37, 3_000))
        for blocks, rows in ((train, own[~is_val[own]]), (val, own[is_val[own]])):
            blocks.add(bins[:, rows], y[rows])
    assert list(bo.boost_blocks(train, val, cuts, [], [], 3, p, lambda own: [own])) == whole
    assert len(train) > 20 and len(val) > 2 and train.starts[-1] == 2_700
