"""A bidirectional LSTM that labels every element of a sequence, in numpy.

An element has bags of hashed tokens (one table of vectors for each kind of
bag, averaged) and plain numbers. Weights are a dict of arrays, so that they
can be sent to any task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

Bag = tuple[np.ndarray, np.ndarray]  # token numbers of all elements, and n + 1 offsets
_CHUNK = 1 << 18


def new_weights(rows: Sequence[int], width: int, numbers: int, hidden: int, seed: int) -> dict[str, np.ndarray]:
    rnd = np.random.default_rng(seed)
    d = width * len(rows) + numbers
    w = {f"table{i}": rnd.normal(0, 0.1, (n, width)) for i, n in enumerate(rows)}
    for side in "fb":
        w |= {f"w{side}": rnd.normal(0, d**-0.5, (d, 4 * hidden)), f"u{side}": rnd.normal(0, hidden**-0.5, (hidden, 4 * hidden)), f"c{side}": np.repeat([0.0, 1.0, 0.0, 0.0], hidden)}
    return w | {"out": rnd.normal(0, 0.1, (2 * hidden,)), "bias": np.zeros(1)}


def bag_means(table: np.ndarray, bag: Bag) -> np.ndarray:
    """The mean vector of each element's tokens (zeros without any); memory
    follows ``_CHUNK``, not the longest bag."""
    tokens, off = bag
    n = len(off) - 1
    out = np.zeros((n, table.shape[1]))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + _CHUNK, "right")) - 1)
        own = tokens[off[at] : off[to]]
        if len(own) > _CHUNK:  # one element
            out[at] = np.bincount(own, minlength=len(table)) @ table
        else:
            full = at + np.flatnonzero(np.diff(off[at : to + 1]))
            if len(full):
                out[full] = np.add.reduceat(table[own], off[full] - off[at], axis=0)
        at = to
    return out / np.maximum(np.diff(off), 1)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _run(x: np.ndarray, w: np.ndarray, u: np.ndarray, c0: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (T, B, H) of one direction over inputs (T, B, D)."""
    steps, batch, _ = x.shape
    hidden = u.shape[0]
    z = x @ w + c0
    h, c = np.zeros((batch, hidden)), np.zeros((batch, hidden))
    out, kept = np.empty((steps, batch, hidden)), []
    for t in range(steps):
        zt = z[t] + h @ u
        gate = _sigmoid(zt[:, : 3 * hidden])
        i, f, o = gate[:, :hidden], gate[:, hidden : 2 * hidden], gate[:, 2 * hidden :]
        g = np.tanh(zt[:, 3 * hidden :])
        before, c = (h, c), f * c + i * g
        th = np.tanh(c)
        h = o * th
        out[t] = h
        if keep:
            kept.append((before, i, f, o, g, th))
    return out, kept


def _back(dh_out: np.ndarray, x: np.ndarray, w: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gradients of inputs, w, u and offsets from those of the states."""
    steps, batch, hidden = dh_out.shape
    dz = np.empty((steps, batch, 4 * hidden))
    du = np.zeros_like(u)
    dh, dc = np.zeros((batch, hidden)), np.zeros((batch, hidden))
    for t in range(steps - 1, -1, -1):
        (h_before, c_before), i, f, o, g, th = kept[t]
        dh = dh + dh_out[t]
        dc = dc + dh * o * (1 - th * th)
        dz[t] = np.concatenate([dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        du += h_before.T @ dz[t]
        dh, dc = dz[t] @ u.T, dc * f
    flat = dz.reshape(-1, dz.shape[2])
    return dz @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


def _layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For padded sequences (T, B): each place's element, the element at the
    mirrored place, and whether a place is inside (elements are numbered one
    sequence after another)."""
    first = np.cumsum(lengths) - lengths
    t = np.arange(int(lengths.max()))[:, None]
    inside = t < lengths
    return np.where(inside, first + t, 0), np.where(inside, first + lengths - 1 - t, 0), inside


def logits(w: dict[str, np.ndarray], x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One logit for each element of sequences of ``lengths`` (all above 0)."""
    ahead, mirrored, inside = _layout(lengths)
    hidden = len(w["out"]) // 2
    out = np.empty(len(x))
    f, _ = _run(x[ahead], w["wf"], w["uf"], w["cf"], False)
    out[ahead[inside]] = (f @ w["out"][:hidden])[inside]
    b, _ = _run(x[mirrored], w["wb"], w["ub"], w["cb"], False)
    out[mirrored[inside]] += (b @ w["out"][hidden:])[inside]
    return out + w["bias"][0]


def gradients(w: dict[str, np.ndarray], bags: Sequence[Bag], numbers: np.ndarray, lengths: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean log loss over the elements with a label (0 or 1), and gradients."""
    means = [bag_means(w[f"table{i}"], bag) for i, bag in enumerate(bags)]
    x = np.concatenate([*means, numbers], axis=1)
    ahead, mirrored, inside = _layout(lengths)
    hidden = len(w["out"]) // 2
    f, kf = _run(x[ahead], w["wf"], w["uf"], w["cf"], True)
    b, kb = _run(x[mirrored], w["wb"], w["ub"], w["cb"], True)
    state = np.empty((len(x), 2 * hidden))
    state[ahead[inside], :hidden], state[mirrored[inside], hidden:] = f[inside], b[inside]
    p = _sigmoid(state @ w["out"] + w["bias"][0])
    known = label >= 0
    n = max(1, int(known.sum()))
    loss = -np.log(np.where(label == 1, p, 1 - p)[known] + 1e-12).sum() / n
    dy = np.where(known, p - label, 0.0) / n
    grads = {"out": state.T @ dy, "bias": dy.sum(keepdims=True)}
    dx = np.zeros_like(x)
    for side, place, kept, half in (("f", ahead, kf, slice(0, hidden)), ("b", mirrored, kb, slice(hidden, None))):
        dh = np.where(inside[:, :, None], dy[place][:, :, None] * w["out"][half], 0.0)
        di, grads[f"w{side}"], grads[f"u{side}"], grads[f"c{side}"] = _back(dh, x[place], w[f"w{side}"], w[f"u{side}"], kept)
        dx[place[inside]] += di[inside]
    width = w["table0"].shape[1]
    for i, (tokens, off) in enumerate(bags):
        size = np.diff(off)
        each = dx[:, i * width : (i + 1) * width] / np.maximum(size, 1)[:, None]
        g = np.zeros_like(w[f"table{i}"])
        np.add.at(g, tokens, np.repeat(each, size, axis=0))
        grads[f"table{i}"] = g
    return float(loss), grads


def adam(w: dict[str, np.ndarray], grads: dict[str, np.ndarray], memory: dict[str, tuple[np.ndarray, np.ndarray]], step: int, rate: float) -> None:
    """One step of Adam, in place; ``memory`` starts empty, ``step`` at 1."""
    for k, g in grads.items():
        m, v = memory.get(k, (np.zeros_like(g), np.zeros_like(g)))
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        memory[k] = (m, v)
        w[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
