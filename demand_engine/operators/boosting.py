"""Gradient-boosted trees grown leaf by leaf, as one barrier job.

Rows are binned by global cut points, which come from all training rows, and
packed by the thousand before they go to the tasks. The tasks of a barrier
stage grow every tree together: each adds up histograms of its own rows
(residual sums and counts by feature and bin), the tasks swap
them through files in the shared folder, and all find the same best splits
from the sums. (``BarrierTaskContext.allGather`` takes about a second a swap,
whatever its size; it is used once, to agree on a folder, and throughout where
Arrow can't open the shared folder.) Only the smaller child of a split is added up, the other is
its parent less that. The leaf with the best gain is split next, up to
``num_leaves``; since a leaf can only be split while enough splits are left,
all leaves that may still be chosen are added up in one swap, so a tree costs
about as many swaps as it is deep.

A task keeps its rows in files of its scratch folder (about 42 bytes a row at
16 features) and goes over them block by block, once for each swap, so its
memory does not grow with its rows.

All sums are exact: residuals are rounded to a fixed step, and their sums stay
below 2**53. So the trees depend on the rows alone, not on how they are dealt.

Margins are kept beside the rows, validation rows included; their loss goes
with the next round's first swap and ends the fit by the patience rule. No
round is fitted twice. After every ``rounds_per_job`` rounds the trees are
written to the shared folder and the next job goes on from them, so a lost
executor costs those rounds at most.

The model is its node table: tree, node, children, feature, threshold, gain,
rows and value, as rows.
"""

from __future__ import annotations

import base64
import json
import os
import sys
import tempfile
import time
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import BarrierTaskContext, TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TREE_FEATURES, TREES_NAME, LeafTreeParams
from ..functions.formatting import prediction_column_name
from ..functions.nulls import clip_negative, fill_zero
from ..session import fresh_path, materialize, shuffles_dropped, table_scope
from .split import validation_flag

# The functions that run in tasks travel with them: executors need not have
# the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_SCHEMA = "tree int, node int, left int, right int, feature int, bin int, threshold double, gain double, n_rows long, value double, loss double"
PACKED_SCHEMA = "task int, is_validation boolean, bins binary, y binary"
Gather = Callable[[np.ndarray], list[np.ndarray]]
#: Residuals may grow to this many times the first largest one before they are clipped.
HEADROOM = 8.0
#: Rows that a task holds at once, and rows packed into one record at most.
BLOCK_ROWS, PACKED_ROWS = 1 << 16, 8_192
#: Ranges of a feature's values that one pass counts, and the largest key of a double.
RANGES, LAST_KEY = 8_192, np.int64(2**63 - 1)


def early_stop(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(trees to keep, whether the patience rule fired within ``losses``).

    Keeps the best validation loss seen before ``patience`` rounds pass
    without improvement.
    """
    best_i, best = 0, float("inf")
    for i, loss in enumerate(losses):
        if loss < best:
            best_i, best = i, loss
        elif i - best_i >= patience:
            return best_i + 1, True
    return best_i + 1, False


def cut_points(values: np.ndarray, max_bins: int) -> np.ndarray:
    """At most ``max_bins - 1`` cuts that part the values into bins of like
    size; bin i holds what is above cut i - 1 and not above cut i."""
    distinct, counts = np.unique(values, return_counts=True)
    return _cuts_between(distinct, _wanted(distinct, distinct, counts, max_bins))


def _wanted(low: np.ndarray, high: np.ndarray, counts: np.ndarray, max_bins: int) -> np.ndarray:
    """The places of the values that have a cut above them, among ascending
    pieces (lowest and highest value, rows): all pieces while there may be no
    more than ``max_bins`` values, else those that the wanted ranks fall in."""
    if np.where(low < high, 2, 1).sum() <= max_bins:
        return np.arange(len(low))
    below = np.cumsum(counts)
    return np.unique(np.searchsorted(below, below[-1] * np.arange(1, max_bins) / max_bins))


def _cuts_between(distinct: np.ndarray, at: np.ndarray) -> np.ndarray:
    at = at[at < len(distinct) - 1]
    low, high = distinct[at], distinct[at + 1]
    return low + (high - low) / 2


def binned(columns: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers (features, rows), a byte each."""
    return np.stack([np.searchsorted(c, x, "left").astype(np.uint8) for x, c in zip(columns, cuts, strict=True)])


def step_for(count: float, largest: float) -> float:
    """The power of two by which values up to ``largest`` are multiplied and
    rounded, so that ``count`` of them add up below 2**52."""
    return 2.0 ** np.floor(52 - np.log2(max(1.0, count) * max(largest, 1e-300)))


def histogram(bins: np.ndarray, q: np.ndarray, features: np.ndarray, width: int, at: np.ndarray, place: np.ndarray, places: int) -> np.ndarray:
    """(places, 2, features, width): sums of ``q`` and counts by bin, of the
    rows ``at``, each of which belongs to a place."""
    out, w, base = np.empty((places, 2, len(features), width)), q.take(at), place * width
    for i, f in enumerate(features):
        b = base + bins[f].take(at)
        out[:, 0, i] = np.bincount(b, weights=w, minlength=places * width).reshape(places, width)
        out[:, 1, i] = np.bincount(b, minlength=places * width).reshape(places, width)
    return out


def best_split(hist: np.ndarray, least: int) -> tuple[float, int, int] | None:
    """(gain, place of the feature, last bin to the left), or None. Equal
    gains go to the first feature and the lowest bin."""
    left = np.cumsum(hist, axis=2)
    total, n = left[:, 0, -1]
    (gl, nl), gr, nr = left, total - left[0], n - left[1]
    good = (nl >= least) & (nr >= least)
    gain = np.where(good, gl * gl / np.maximum(nl, 1) + gr * gr / np.maximum(nr, 1) - total * total / max(n, 1), -np.inf)
    at = int(np.argmax(gain))
    f, b = divmod(at, gain.shape[1])
    return (float(gain[f, b]), f, b) if gain[f, b] > 0 else None


class _Node:
    def __init__(self, path: tuple[int, ...], label: int, hist: np.ndarray, least: int):
        self.path, self.label, self.hist = path, label, hist
        self.total, self.n = (float(x) for x in hist[:, 0].sum(1))
        self.split = best_split(hist, least)
        self.kids: tuple[_Node, _Node] | None = None


class _Blocks:
    """Rows of a task in blocks, in files of its scratch folder: bins, target,
    margin, rounded residual, and the label of the node that holds the row."""

    def __init__(self, features: int, leaves: int):
        folders = [x for x in os.environ.get("SPARK_LOCAL_DIRS", "").split(",") if os.path.isdir(x)]
        folder = folders[os.getpid() % len(folders)] if folders else None
        labels = np.uint16 if 2 * leaves * leaves < 2**16 else np.uint32
        self.kinds = {"bins": (np.uint8, features), "y": (np.float64, 1), "margin": (np.float64, 1), "q": (np.float64, 1), "label": (labels, 1)}
        # without names, so they go with the task however it ends
        self.files = {kind: tempfile.TemporaryFile(dir=folder, buffering=0) for kind in self.kinds}
        self.starts, self.held, self.waiting = [0], [], 0
        self.room = {kind: np.empty(0, dtype) for kind, (dtype, _) in self.kinds.items()}

    def __len__(self) -> int:
        return len(self.starts) - 1

    def add(self, bins: np.ndarray, y: np.ndarray) -> None:
        self.held.append((bins, y))
        self.waiting += len(y)
        if self.waiting >= BLOCK_ROWS:
            self.end_block()

    def end_block(self) -> None:
        if self.waiting:
            self.starts.append(self.starts[-1] + self.waiting)
            for kind, parts in zip(("bins", "y"), zip(*self.held, strict=True), strict=True):
                self.put(kind, len(self) - 1, np.concatenate(parts, axis=-1))
            self.held, self.waiting = [], 0

    def _at(self, kind: str, i: int) -> int:
        dtype, each = self.kinds[kind]
        return self.starts[i] * each * np.dtype(dtype).itemsize

    def get(self, kind: str, i: int) -> np.ndarray:
        """Block ``i``, in memory that the next block of its kind takes over."""
        dtype, each = self.kinds[kind]
        n, f = self.starts[i + 1] - self.starts[i], self.files[kind]
        if len(self.room[kind]) < each * n:
            self.room[kind] = np.empty(each * n, dtype)
        out = self.room[kind][: each * n]
        f.seek(self._at(kind, i))
        if f.readinto(out) != out.nbytes:
            raise OSError("the task's scratch file ends early")
        return out.reshape(each, n) if kind == "bins" else out

    def put(self, kind: str, i: int, values: np.ndarray) -> None:
        dtype, f = self.kinds[kind][0], self.files[kind]
        left = memoryview(np.ascontiguousarray(values, dtype).reshape(-1)).cast("B")
        f.seek(self._at(kind, i))
        while left:
            left = left[f.write(left):]

    def close(self) -> None:
        for f in self.files.values():
            f.close()

    def part(self, todo: list[_Node], labels: int, small: Sequence[int], features: np.ndarray, width: int) -> np.ndarray:
        """Gives the rows of the nodes the labels of their kids, which begin
        at ``labels``; the histograms of each node's kid ``small``."""
        dtype, mine = self.kinds["label"][0], [x.label for x in todo]
        feature, last, kid, side, place = (np.zeros(labels, kind) for kind in (np.int64, np.uint8, dtype, bool, np.int64))
        feature[:] = -1
        feature[mine], last[mine] = features[[x.split[1] for x in todo]], [x.split[2] for x in todo]
        kid[mine], side[mine], place[mine] = labels + 2 * np.arange(len(todo)), small, np.arange(len(todo))
        out = np.zeros((len(todo), 2, len(features), width))
        for i in range(len(self)):
            label = self.get("label", i)
            at = np.flatnonzero((feature >= 0).take(label))
            if not len(at):
                continue
            bins, was = self.get("bins", i), label.take(at).astype(np.intp)
            right = bins.ravel().take(feature.take(was) * len(label) + at) > last.take(was)
            label[at] = kid.take(was) + right
            self.put("label", i, label)
            own = np.flatnonzero(right == side.take(was))
            out += histogram(bins, self.get("q", i), features, width, at.take(own), place.take(was.take(own)), len(todo))
        return out


def _chosen(root: _Node, leaves: int) -> tuple[list[_Node], list[_Node]]:
    """The nodes that best-first growth splits, in order, as far as known; and
    the leaves that must be split before it can be said how it goes on (all
    that may still be chosen)."""
    front, out = [root], []
    while len(out) < leaves - 1:
        front = sorted((x for x in front if x.split), key=lambda x: (-x.split[0], x.path))
        if not front:
            break
        if front[0].kids is None:
            return out, [x for x in front[: leaves - 1 - len(out)] if x.kids is None]
        out.append(front[0])
        front = front[1:] + list(front[0].kids)
    return out, []


def grow(blocks: _Blocks, root_hist: np.ndarray, features: np.ndarray, leaves: int, least: int, max_depth: int, gather: Gather) -> tuple[list[_Node], int]:
    """The nodes that are split, best first, with their kids on them; and how
    many labels the rows have. All rows begin with label 0."""
    root, labels = _Node((), 0, root_hist, least), 1
    while True:
        out, todo = _chosen(root, leaves)
        if not todo:
            return out, labels
        small = []
        for node in todo:
            _, f, b = node.split
            n_left = node.hist[1, f, : b + 1].sum()
            small.append(0 if 2 * n_left <= node.n else 1)
        own = blocks.part(todo, labels, small, features, root_hist.shape[2])
        for node, s, h in zip(todo, small, sum(gather(own)), strict=True):
            hists = (h, node.hist - h) if s == 0 else (node.hist - h, h)
            node.kids = tuple(_Node((*node.path, i), labels + i, hists[i], least) for i in (0, 1))
            node.hist, labels = None, labels + 2
            if max_depth > 0 and len(node.path) + 1 >= max_depth:
                for kid in node.kids:
                    kid.split = None


def tree_rows(split: list[_Node], labels: int, features: np.ndarray, cuts: Sequence[np.ndarray], step: float, rate: float) -> tuple[list[dict], np.ndarray]:
    """The tree's nodes in the order in which growth makes them, and the value
    of a row by its label (leaves that growth parted ahead keep theirs)."""
    number, rows, values = {(): 0}, [], np.zeros(labels)
    for node in split:
        for kid in node.kids:
            number[kid.path] = len(number)
    nodes = {(): split[0]} | {kid.path: kid for node in split for kid in node.kids}
    inner = {node.path for node in split}
    for path, node in nodes.items():
        row = {"node": number[path], "left": -1, "right": -1, "feature": -1, "bin": -1, "threshold": None, "gain": 0.0, "n_rows": int(node.n), "value": rate * (node.total / node.n / step)}
        if path in inner:
            gain, f, b = node.split
            f = int(features[f])
            row |= {"left": number[(*path, 0)], "right": number[(*path, 1)], "feature": f, "bin": b, "threshold": float(cuts[f][b]), "gain": gain / step / step}
        else:
            below = [node]
            while below:
                x = below.pop()
                values[x.label] = row["value"]
                below += x.kids or ()
        rows.append(row)
    return rows, values


def add_tree(margin: np.ndarray, bins: np.ndarray, nodes: Sequence[dict]) -> None:
    """Adds a tree's values to the margins of rows given by their bins."""
    held = {0: np.arange(bins.shape[1])}
    for x in nodes:  # parents come before their kids
        rows = held.pop(x["node"])
        if x["left"] < 0:
            margin[rows] += x["value"]
        else:
            left = bins[x["feature"]][rows] <= x["bin"]
            held[x["left"]], held[x["right"]] = rows[left], rows[~left]


def drawn_features(count: int, share: float, seed: int, tree: int) -> np.ndarray:
    """The features that a tree may use, ascending."""
    k = min(count, max(1, round(share * count)))
    return np.sort(np.random.default_rng([seed, tree]).permutation(count)[:k])


def boost(bins: np.ndarray, y: np.ndarray, is_val: np.ndarray, cuts: Sequence[np.ndarray], before: Sequence[Sequence[dict]], losses: Sequence[float], until: int, p: LeafTreeParams, gather: Gather) -> Iterator[list[dict]]:
    """``boost_blocks`` over rows in memory."""
    train, val = _Blocks(len(bins), p.num_leaves), _Blocks(len(bins), p.num_leaves)
    for blocks, own in ((train, ~is_val), (val, is_val)):
        blocks.add(bins[:, own], y[own])
    yield from boost_blocks(train, val, cuts, before, losses, until, p, gather)


def boost_blocks(train: _Blocks, val: _Blocks, cuts: Sequence[np.ndarray], before: Sequence[Sequence[dict]], losses: Sequence[float], until: int, p: LeafTreeParams, gather: Gather) -> Iterator[list[dict]]:
    """Trees number ``len(before)`` up to ``until``, each as rows; every task
    of a fit calls this with its own rows and gets the same trees. The first
    row of a tree carries the validation loss with it."""
    for blocks in (train, val):
        blocks.end_block()
    largest = max((np.abs(train.get("y", i)).max() for i in range(len(train))), default=0.0)
    seen = np.stack(gather(np.array([train.starts[-1], val.starts[-1], largest])))
    n, n_val, largest = seen[:, 0].sum(), seen[:, 1].sum(), seen[:, 2].max()
    if not n:
        return
    step = step_for(n, largest)
    own = sum((np.rint(train.get("y", i) * step).sum() for i in range(len(train))), 0.0)
    start = float(sum(gather(np.array([own])))[0] / step / n)
    apart = max((np.abs(x.get("y", i) - start).max() for x in (train, val) for i in range(len(x))), default=0.0)
    apart = max(float(x[0]) for x in gather(np.array([apart])))
    if not before:
        yield [{"node": 0, "left": -1, "right": -1, "feature": -1, "bin": -1, "threshold": None, "gain": 0.0, "n_rows": int(n), "value": start, "loss": None}]
    step, loss_step = step_for(n, HEADROOM * apart), step_for(n_val, (HEADROOM * apart) ** 2)
    losses, width, rounds = list(losses), 1 + max(len(c) for c in cuts), len(before)
    counts = np.zeros((len(cuts), width))
    for blocks in (train, val):
        for i in range(len(blocks)):
            bins = blocks.get("bins", i)
            margin = np.full(bins.shape[1], start)
            for nodes in before:
                add_tree(margin, bins, nodes)
            blocks.put("margin", i, margin)
            if blocks is train:
                counts += [np.bincount(b, minlength=width) for b in bins]
    waiting: list[dict] | None = None
    values = np.zeros(1)

    def own_loss() -> float:
        total = 0.0
        for i in range(len(val)):
            margin = val.get("margin", i)
            if waiting is not None:
                add_tree(margin, val.get("bins", i), waiting)
                val.put("margin", i, margin)
            total += np.rint(np.minimum((val.get("y", i) - margin) ** 2, (HEADROOM * apart) ** 2) * loss_step).sum()
        return total

    def own_sums(features: np.ndarray) -> np.ndarray:
        """The last tree goes into the margins; histograms of the residuals."""
        out = np.zeros((2, len(features), width))
        out[1] = counts[features]
        for i in range(len(train)):
            margin = train.get("margin", i)
            if waiting is not None:
                margin += values[train.get("label", i)]
                train.put("margin", i, margin)
            q = np.rint(np.clip(train.get("y", i) - margin, -HEADROOM * apart, HEADROOM * apart) * step)
            train.put("q", i, q)
            train.put("label", i, np.zeros(len(q)))
            bins = train.get("bins", i)
            for k, f in enumerate(features):
                out[0, k] += np.bincount(bins[f], weights=q, minlength=width)
        return out

    while True:
        last = rounds >= until
        features = drawn_features(len(cuts), p.colsample_bytree, p.seed, rounds)
        loss, own = own_loss(), np.empty(0) if last else own_sums(features).ravel()
        total = sum(gather(np.concatenate([[loss], own])))
        if waiting is not None:
            losses.append(total[0] / loss_step / max(n_val, 1))
            waiting[0]["loss"] = losses[-1]
            yield waiting
        if last or (n_val and early_stop(losses, p.early_stopping_rounds)[1]):
            return
        split, labels = grow(train, total[1:].reshape(2, len(features), width), features, p.num_leaves, p.min_child_samples, p.max_depth, gather)
        if not split:
            return
        waiting, values = tree_rows(split, labels, features, cuts, step, p.learning_rate)
        rounds += 1


def _gather_by_barrier(context: BarrierTaskContext) -> Gather:
    """Every task's array, in the order of the tasks."""

    def gather(own: np.ndarray) -> list[np.ndarray]:
        said = context.allGather(base64.b64encode(zlib.compress(own.astype(np.float64).tobytes(), 1)).decode())
        return [np.frombuffer(zlib.decompress(base64.b64decode(x))).reshape(own.shape) for x in said]

    return gather


def _gather_by_files(files: pafs.FileSystem, folder: str, me: int, tasks: int) -> Gather:
    """The same through ``folder``, one file a task and swap. A task that has
    all files of a swap knows that all have read the swap before, so it
    deletes its own file of that one: a fit holds two files a task at most."""
    swaps = 0

    def gather(own: np.ndarray) -> list[np.ndarray]:
        nonlocal swaps
        mine = f"{folder}/{swaps}-{me}"
        with files.open_output_stream(f"{mine}.part") as f:
            f.write(own.astype(np.float64).tobytes())
        files.move(f"{mine}.part", mine)  # a file is there whole or not at all
        said: dict[int, np.ndarray] = {me: own.astype(np.float64)}
        wait = 0.0005
        while len(said) < tasks:
            absent = [i for i in range(tasks) if i not in said]
            found = [i for i, x in zip(absent, files.get_file_info([f"{folder}/{swaps}-{i}" for i in absent]), strict=True) if x.type == pafs.FileType.File]
            for i in found:
                with files.open_input_stream(f"{folder}/{swaps}-{i}") as f:
                    said[i] = np.frombuffer(f.read()).reshape(own.shape)
            if not found:
                time.sleep(wait)
            wait = 0.0005 if found else min(0.02, 1.5 * wait)
        if swaps:
            files.delete_file(f"{folder}/{swaps - 1}-{me}")
        swaps += 1
        return [said[i] for i in range(tasks)]

    return gather


def _gather_among(context: BarrierTaskContext, tasks: int, shared: str) -> Gather:
    """Through files below ``shared`` where all tasks can open it, in a folder
    that no other run of the job uses."""
    try:
        files, path = pafs.FileSystem.from_uri("file://" + shared[5:] if shared.startswith("file:/") and not shared.startswith("file://") else shared)
        path = f"{path}/{uuid.uuid4().hex}"
        files.create_dir(path)
    except (pa.ArrowException, OSError, ImportError):
        files = path = None
    said = [json.loads(x) for x in context.allGather(json.dumps(path))]
    if None in said:
        return _gather_by_barrier(context)
    return _gather_by_files(files, said[0], context.partitionId(), tasks)


def packed(data: DataFrame, cuts: Sequence[np.ndarray], tasks: int, rows: int) -> DataFrame:
    """``data`` (x0, x1, ..., y, is_validation) as records of up to ``rows``
    rows each, dealt to the tasks in turn."""
    features = len(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = [TaskContext.get().partitionId()] * 2
        for b in batches:
            bins = binned([b.column(i).to_numpy(zero_copy_only=False) for i in range(features)], cuts)
            y, is_val = (b.column(features + i).to_numpy(zero_copy_only=False) for i in range(2))
            out = []
            for flag in (False, True):
                at = np.flatnonzero(is_val.astype(bool) == flag)
                for own in np.array_split(at, -(-len(at) // rows)) if len(at) else ():
                    out.append((dealt[flag] % tasks, flag, bins[:, own].tobytes(), y[own].astype(np.float64).tobytes()))
                    dealt[flag] += 1
            kinds = {"task": pa.int32(), "is_validation": pa.bool_(), "bins": pa.binary(), "y": pa.binary()}
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds.values())], [*kinds])

    return data.mapInArrow(run, PACKED_SCHEMA)


def fit_job(data: DataFrame, cuts: Sequence[np.ndarray], tasks: int, before: Sequence[Sequence[dict]], losses: Sequence[float], until: int, p: LeafTreeParams) -> DataFrame:
    """One barrier job over ``packed`` rows: the new trees as rows of
    ``NODE_SCHEMA``. Tree -1 is the first margin."""
    settings = {f: getattr(p, f) for f in p.__dataclass_fields__}
    features, first, shared = len(cuts), len(before), fresh_path(data.sparkSession, "swaps")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from types import SimpleNamespace

        train, val = _Blocks(features, settings["num_leaves"]), _Blocks(features, settings["num_leaves"])
        for b in batches:
            for is_val, bins, y in zip(*(b.column(i) for i in (1, 2, 3)), strict=True):
                (val if is_val.as_py() else train).add(np.frombuffer(bins.as_buffer(), np.uint8).reshape(features, -1), np.frombuffer(y.as_buffer()))
        context = BarrierTaskContext.get()
        gather = _gather_among(context, tasks, shared) if tasks > 1 else lambda own: [own]
        number = first - (0 if first else 1)
        names = [x.split(" ")[0] for x in NODE_SCHEMA.split(", ")]
        for nodes in boost_blocks(train, val, cuts, before, losses, until, SimpleNamespace(**settings), gather):
            if context.partitionId() == 0:
                rows = [x | {"tree": number, "loss": x.get("loss")} for x in nodes]
                kinds = (pa.int32(),) * 6 + (pa.float64(), pa.float64(), pa.int64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], kind) for c, kind in zip(names, kinds, strict=True)], names)
            number += 1
        train.close()
        val.close()

    return data.repartitionById(tasks, "task").mapInArrow(run, NODE_SCHEMA, barrier=True)


@dataclass
class LeafTreesModel:
    """An ensemble: the first margin and the rows of its trees."""

    features: list[str]
    start: float
    nodes: list[dict]
    n_trees: int
    validation_losses: list[float] = field(default_factory=list)
    rounds_fitted: int = 0
    name: str = TREES_NAME

    @property
    def output_col(self) -> str:
        return prediction_column_name(self.name)

    def node_table(self, spark: SparkSession) -> DataFrame:
        """The kept trees as rows (bounded by rounds and leaves), features by
        their names."""
        rows = [(x["tree"], x["node"], x["left"], x["right"], self.features[x["feature"]] if x["feature"] >= 0 else None, x["threshold"], x["gain"], x["n_rows"], x["value"] if x["left"] < 0 else None) for x in self.nodes]
        return spark.createDataFrame(rows, "tree int, node int, left int, right int, feature string, threshold double, gain double, n_rows long, value double")

    def scorer(self) -> Callable[[pa.Array], pa.Array]:
        """Sums of all trees for a batch of feature arrays: the rows of the
        batch are parted at each node, a few vector passes a tree. (A native
        expression with a branch a node outgrows what Spark can compile, and
        one that steps through constant arrays costs a millisecond a row.)"""
        trees: dict[int, list[dict]] = {}
        for x in self.nodes:
            trees.setdefault(x["tree"], []).append(x)
        ordered = [sorted(own, key=lambda x: x["node"]) for _, own in sorted(trees.items())]
        start, width = self.start, len(self.features)

        def score(batch: pa.Array) -> pa.Array:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).T
            total = np.full(len(batch), start)
            for nodes in ordered:
                held = {0: np.arange(len(batch))}
                for n in nodes:
                    rows = held.pop(n["node"])
                    if n["left"] < 0:
                        total[rows] += n["value"]
                    else:
                        left = x[n["feature"]][rows] <= n["threshold"]
                        held[n["left"]], held[n["right"]] = rows[left], rows[~left]
            return pa.array(total)

        return score

    def predict(self, df: DataFrame) -> DataFrame:
        inputs = F.array(*[fill_zero(c) for c in self.features])
        return df.withColumn(self.output_col, clip_negative(F.arrow_udf(self.scorer(), "double")(inputs)))

    def feature_importances_df(self, spark: SparkSession) -> DataFrame:
        """One row per feature, by one aggregate over the node table: its
        share of all gains, and how many splits use it."""
        every = spark.createDataFrame([(c,) for c in self.features], "feature string")
        by = self.node_table(spark).where("left >= 0").groupBy("feature").agg(F.sum("gain").alias("gain"), F.count("*").alias("splits"))
        total = by.agg(F.sum("gain")).scalar()
        return every.join(by, "feature", "left").select(
            "feature", F.coalesce(F.try_divide("gain", total), F.lit(0.0)).alias("importance"), F.coalesce("splits", F.lit(0)).alias("splits")
        ).orderBy(F.desc("importance"), "feature")

    def feature_importances(self) -> list[tuple[str, float, int]]:
        """The same as a list on the driver, descending."""
        gains, splits = dict.fromkeys(self.features, 0.0), dict.fromkeys(self.features, 0)
        for x in self.nodes:
            if x["left"] >= 0:
                gains[self.features[x["feature"]]] += x["gain"]
                splits[self.features[x["feature"]]] += 1
        total = sum(gains.values())
        return sorted(((f, gains[f] / total if total else 0.0, splits[f]) for f in self.features), key=lambda t: (-t[1], t[0]))


def as_keys(values: np.ndarray) -> np.ndarray:
    """Doubles as integers in the same order, both zeros as one."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, bits ^ LAST_KEY, bits)


def from_keys(keys: np.ndarray) -> np.ndarray:
    return np.where(keys < 0, keys ^ LAST_KEY, keys).view(np.float64)


def _parted(first: np.ndarray, last: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of keys, each in at most so many parts of like width."""
    firsts, lasts = [], []
    for a, z in zip(first.tolist(), last.tolist(), strict=True):
        width = z - a + 1
        edges = sorted({a + width * i // parts for i in range(parts)})
        firsts += edges
        lasts += [*(x - 1 for x in edges[1:]), z]
    return np.array(firsts, np.int64), np.array(lasts, np.int64)


def _pieces(data: DataFrame, columns: Sequence[str], asked: dict[int, tuple[np.ndarray, np.ndarray, bool]]) -> pa.Table:
    """What all rows hold in the asked ranges of keys: for each feature and
    range with rows its lowest and highest key and the number of rows; where
    the third part is true, the same for each key inside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {f: (np.full(len(first), LAST_KEY), np.full(len(first), -LAST_KEY - 1), np.zeros(len(first), np.int64)) for f, (first, _, each) in asked.items() if not each}
        names = ["feature", "part", "low", "high", "n"]

        def rows(f: int, part: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), f, np.int32)), *(pa.array(x.astype(np.int64)) for x in (part, low, high, n))], names)

        def look(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for values, (f, (first, last, each)) in zip(held, asked.items(), strict=True):
                keys = np.sort(as_keys(np.concatenate(values)))
                start, end = np.searchsorted(keys, first, "left"), np.searchsorted(keys, last, "right")
                some = np.flatnonzero(end > start)
                if each and len(some):
                    inside, n = np.unique(np.concatenate([keys[a:z] for a, z in zip(start[some], end[some], strict=True)]), return_counts=True)
                    yield rows(f, inside, inside, inside, n)
                elif len(some):
                    low, high, n = found[f]
                    low[some] = np.minimum(low[some], keys[start[some]])
                    high[some] = np.maximum(high[some], keys[end[some] - 1])
                    n[some] += (end - start)[some]

        held, count = [[] for _ in asked], 0
        for b in batches:
            for own, x in zip(held, b.columns, strict=True):
                own.append(x.to_numpy(zero_copy_only=False))
            count += b.num_rows
            if count >= BLOCK_ROWS:
                yield from look(held)
                held, count = [[] for _ in asked], 0
        if count:
            yield from look(held)
        for f, (low, high, n) in found.items():
            some = np.flatnonzero(n)
            if len(some):
                yield rows(f, asked[f][0][some], low[some], high[some], n[some])

    parts = data.select(*[columns[f] for f in asked]).mapInArrow(run, "feature int, part long, low long, high long, n long")
    return parts.groupBy("feature", "part").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).toArrow()


def all_cut_points(data: DataFrame, columns: Sequence[str], rows: int, count: int, max_bins: int) -> list[np.ndarray]:
    """``cut_points`` of each column over all its ``count`` rows. Up to
    ``rows`` rows come to the driver. Beyond, passes over the rows count them
    in ranges of values; a pass parts only the ranges that hold the value of
    a wanted rank, until those are single values. The driver holds some
    thousand ranges a feature, and values only once few rows are left."""
    if count <= rows:
        table = data.select(*columns).toArrow()
        return [cut_points(table.column(c).to_numpy(), max_bins) for c in columns]
    pieces = [(np.array([-LAST_KEY - 1]), np.array([LAST_KEY]), np.array([count])) for _ in columns]
    while True:
        asked, opened = {}, {}
        for f, (low, high, n) in enumerate(pieces):
            at = _wanted(low, high, n, max_bins)
            at = at[low[at] < high[at]]
            if len(at):
                opened[f], each = at, int(n[at].sum()) <= rows // 4
                asked[f] = (low[at], high[at], True) if each else (*_parted(low[at], high[at], max(2, RANGES // len(at))), False)
        if not asked:
            break
        table = _pieces(data, columns, asked)
        feature, found = table.column("feature").to_numpy(), [table.column(c).to_numpy() for c in ("low", "high", "n")]
        for f, at in opened.items():
            merged = [np.concatenate([np.delete(was, at), new[feature == f]]) for was, new in zip(pieces[f], found, strict=True)]
            order = np.argsort(merged[0])
            pieces[f] = tuple(x[order] for x in merged)
    return [_cuts_between(from_keys(low), _wanted(low, high, n, max_bins)) for low, high, n in pieces]


class LeafTreesForecaster:
    """Boosted regression trees grown best leaf first, with early stopping."""

    name = TREES_NAME

    def __init__(self, params: LeafTreeParams | None = None, features: Sequence[str] = TREE_FEATURES, target: str = "Weekly_Sales"):
        self.params = params or LeafTreeParams()
        self.features = list(features)
        self.target = target

    def fit(self, train: DataFrame) -> LeafTreesModel:
        """The model holds its trees itself; the tables of the fit go with it."""
        with table_scope(train.sparkSession):
            return self._fit(train)

    def _fit(self, train: DataFrame) -> LeafTreesModel:
        p, spark = self.params, train.sparkSession
        names = [c for c in self.features if c in train.columns]
        flagged = validation_flag(train, p.validation_fraction, p.validation_mode)
        columns = [f"x{i}" for i in range(len(names))]
        rows = flagged.where(F.col(self.target).isNotNull()).select(*[fill_zero(c).alias(x) for c, x in zip(names, columns, strict=True)], F.col(self.target).cast("double").alias("y"), "is_validation")
        path = fresh_path(spark, "tree-bins")
        with table_scope(spark):  # the rows go once they are packed
            data = materialize(rows, "tree-rows")
            counts = data.agg(F.count_if(~F.col("is_validation")).alias("n"), F.count("*").alias("all")).first()
            if not counts["n"]:
                return LeafTreesModel(names, float(data.agg(F.avg("y")).first()[0] or 0.0), [], 0, [], 0, self.name)
            cuts = all_cut_points(data.where(~F.col("is_validation")), columns, p.bin_sample_rows, counts["n"], p.max_bins)
            tasks = max(1, min(p.max_tasks, spark.sparkContext.defaultParallelism, -(-counts["all"] // p.rows_per_task)))
            each = max(256, min(PACKED_ROWS, counts["all"] // (16 * tasks)))
            # small row groups: a reader holds one at a time
            packed(data, cuts, tasks, each).write.option("parquet.block.size", 16 << 20).parquet(path)
        dealt = spark.read.schema(PACKED_SCHEMA).parquet(path)
        nodes: list[list[dict]] = []
        start, losses, keep, stopped, fitted = 0.0, [], 0, False, 0
        while not stopped and len(nodes) < p.n_estimators:
            until = min(p.n_estimators, len(nodes) + p.rounds_per_job)
            # as rows in the shared folder: bounded by rounds and leaves
            with shuffles_dropped(spark):
                done = materialize(fit_job(dealt, cuts, tasks, nodes, losses, until, p), "trees")
            trees: dict[int, list[dict]] = {}
            for r in sorted((r.asDict() for r in done.collect()), key=lambda r: (r["tree"], r["node"])):
                trees.setdefault(r["tree"], []).append(r)
            if -1 in trees:
                start = trees.pop(-1)[0]["value"]
            nodes += [trees[t] for t in sorted(trees)]
            losses += [trees[t][0]["loss"] for t in sorted(trees)]
            fitted += len(trees)
            keep, stopped = early_stop(losses, p.early_stopping_rounds) if losses else (0, False)
            if len(nodes) < until:  # stopped by patience, or no leaf can be split
                break
        kept = [x for own in nodes[:keep] for x in own]
        return LeafTreesModel(names, start, kept, keep, losses, fitted, self.name)
