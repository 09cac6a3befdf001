"""Removal of repeated byte windows by a depth-limited radix order of suffixes.

A window of ``depth`` bytes that also starts in a document with a smaller id
is repeated; every byte that a repeated window covers is removed. Suffixes
are ordered only through ``depth`` bytes and by most-significant digits:

1. Suffixes are taken at anchors: in every window the ``k``-byte strings
   with the least hash. Equal windows have equal anchors, so about
   2 / (depth - k + 2) of all suffixes stand for every window. The first
   digit, the anchor's k bytes, deals them into groups.
2. The second digit is all the bytes around the anchor that its windows can
   reach. Equal digits are one context: all but its smallest document are
   repeats, whole. Tasks combine equal contexts before anything is shuffled.
3. Groups that still hold several contexts are ordered through the last
   digits: for each offset of the anchor, windows with equal bytes form a
   group, and those in a larger document than the group's smallest repeat.
   Where an anchor has very many contexts, its windows are dealt by their
   own hashes instead, and the least documents are aggregated before they
   are shuffled.

Rows move as packed arrays, a row for each piece and bucket; the buckets'
number follows the bytes of the input. Digits are 96-bit (context) and
128-bit (window) hashes.

Cases: null or empty texts have nothing to remove; documents shorter than
``depth`` stay; rows that share an id are not smaller than each other; null
ids come after all ids and not before each other; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as tx
from .scratch import materialise

#: Bytes of text for each bucket, and for each piece that a task hashes at a
#: time (a dozen 8-byte arrays of that length).
BUCKET_BYTES = 16 << 20
PIECE_BYTES = 2 << 20
#: Contexts of one anchor above which its windows are dealt by their own
#: hashes, and rows that a task compares at a time.
HOT_CONTEXTS = 20_000
#: Parts of a document bucket that have their windows hashed apart.
HOT_PARTS = 16
_NO_ID = np.iinfo(np.int64).max
_P = np.uint64(0x9E3779B97F4A7C15)
_TABLE = tx.mix(np.arange(1, 257, dtype=np.uint64) * _P)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_P), n, 1 << 64))


def rolling(buf: np.ndarray, k: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``k`` bytes, made by doubling."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    part, have, out, done = _TABLE[buf], 1, None, 0
    while True:
        if k & have:
            if out is None:
                out, done = part[: len(part)].copy(), have
            else:  # the bits so far, then the next block after them
                m = min(len(out), len(part) - done)
                out, done = out[:m] * _power(have) + part[done : done + m], done + have
        if have * 2 > k:
            return out[:n]
        part = part[:-have] * _power(have) + part[have:]
        have *= 2


def _sliding(x: np.ndarray, w: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (minimum or maximum) over all runs of ``w`` values."""
    have, now = 1, x
    while have * 2 <= w:
        now = pick(now[:-have], now[have:])
        have *= 2
    rest = w - have
    return pick(now[: len(now) - rest], now[rest:]) if rest else now


def anchors(buf: np.ndarray, off: np.ndarray, depth: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all windows' least k-byte strings, and all k-hashes."""
    n = len(buf)
    if n < depth:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = rolling(buf, k)
    order = tx.mix(hashes) | np.uint64(1)
    w = depth - k + 1
    least = _sliding(order, w, np.minimum)  # by window start
    edge = np.zeros(n + 1, np.int8)
    np.add.at(edge, np.maximum(off[:-1], off[1:] - depth + 1), 1)
    np.add.at(edge, off[1:], -1)
    least[np.cumsum(edge[:-1], dtype=np.int8)[: len(least)] > 0] = 0  # windows that cross a text's end
    padded = np.zeros(len(least) + 2 * (w - 1), np.uint64)
    padded[w - 1 : w - 1 + len(least)] = least
    return np.flatnonzero(_sliding(padded, w, np.maximum) == order), hashes


def contexts(buf: np.ndarray, off: np.ndarray, depth: int, k: int) -> dict[str, np.ndarray]:
    """For each anchor: text number, context bounds and the two digits."""
    at, hashes = anchors(buf, off, depth, k)
    doc = np.searchsorted(off, at, "right") - 1
    reach = depth - k
    lo, hi = np.maximum(off[doc], at - reach), np.minimum(off[doc + 1], at + depth)
    first = tx.mix(hashes[at]) if len(at) else np.empty(0, np.uint64)
    second = np.zeros(len(at), np.uint64)
    inner = (at - lo == reach) & (hi - at == depth)
    p = at[inner]
    acc = np.zeros(len(p), np.uint64)
    steps = [*range(-reach, depth - k, k), depth - k]
    for s in steps:
        acc = tx.mix(acc * _P + hashes[p + s])
    second[inner] = acc
    for i in np.flatnonzero(~inner):
        second[i] = xxhash.xxh3_64_intdigest(buf[lo[i] : hi[i]].tobytes(), int(at[i] - lo[i]))
    return {"doc": doc, "lo": lo - off[doc], "hi": hi - off[doc], "at": at - off[doc], "first": first, "second": second}


def _least_in_group(new: np.ndarray, value: np.ndarray) -> np.ndarray:
    """For sorted rows with group starts ``new``: the group's least value."""
    if not len(value):
        return value
    starts = np.flatnonzero(new)
    return np.repeat(np.minimum.reduceat(value, starts), np.diff(np.append(starts, len(value))))


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    if len(new) > 1:
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal keys."""
    at = np.flatnonzero(_starts(*keys)).tolist() if len(keys[0]) else []
    return list(zip(at, [*at[1:], len(keys[0])], strict=False))


#: Columns of packed rows and how they are packed.
_KEYS = {"id": "<i8", "th": "<i8", "db": "<i4"}
_SPANS = {**_KEYS, "lo": "<u4", "hi": "<u4"}
_SUFFIXES = {**_SPANS, "at": "<u4", "first": "<u8", "second": "<u4", "second_top": "<u2", "step": "<u4", "more": "<u4"}
_CUT = "db int, blob binary"


def _pack(rows: dict[str, np.ndarray], kinds: dict[str, str], pick: np.ndarray) -> bytes:
    """Columns one after another. Bounds are kept as distances, which are
    mostly equal; documents' keys repeat; so both pack well."""
    own = {c: rows[c][pick] for c in kinds}
    own["hi"] = own["hi"].astype(np.int64) - own["lo"].astype(np.int64)
    if "at" in own:
        own["lo"] = own["at"].astype(np.int64) - own["lo"].astype(np.int64)
    return zstandard.ZstdCompressor(level=1).compress(len(pick).to_bytes(8, "little") + b"".join(own[c].astype(t).tobytes() for c, t in kinds.items()))


def _unpack(blobs: list[bytes], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    out: dict[str, list[np.ndarray]] = {c: [np.empty(0, t)] for c, t in kinds.items()}
    for blob in blobs:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n, p = int.from_bytes(raw[:8], "little"), 8
        own = {}
        for c, t in kinds.items():
            own[c] = np.frombuffer(raw, t, n, p)
            p += n * np.dtype(t).itemsize
        if "at" in own:
            own["lo"] = own["at"] - own["lo"]
        own["hi"] = own["lo"] + own["hi"]
        for c in kinds:
            out[c].append(own[c])
    return {c: np.concatenate(v) for c, v in out.items()}


def _dealt(rows: dict[str, np.ndarray], kinds: dict[str, str], bucket: np.ndarray) -> Iterator[tuple[int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    for a, b in _runs(bucket[order]):
        yield int(bucket[order[a]]), _pack(rows, kinds, order[a:b])


def _resolve(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Orders rows by both digits; returns the order and, in it, each
    context's smallest document."""
    second = rows["second"].astype(np.uint64) | (rows["second_top"].astype(np.uint64) << np.uint64(32))
    order = np.lexsort((rows["lo"], rows["id"], second, rows["first"]))
    least = _least_in_group(_starts(rows["first"][order], second[order]), rows["id"][order])
    return order, least


def suffix_digits(src: DataFrame, depth: int, k: int, buckets: int) -> DataFrame:
    """Packed rows (kind, bucket, blob): 0, suffixes by their first digit;
    1, spans already known to repeat, by their document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tx.pieces(batches, "text", PIECE_BYTES):
            buf, off = tx.text_bytes(piece.column("text"))
            got = contexts(buf, off, depth, k)
            keys = {c: piece.column(c).to_numpy() for c in _KEYS}
            rows = {c: v[got["doc"]] for c, v in keys.items()} | {c: got[c] for c in ("lo", "hi", "at", "first")}
            rows |= {"second": got["second"] & np.uint64(0xFFFFFFFF), "second_top": (got["second"] >> np.uint64(32)) & np.uint64(0xFFFF)}
            order, least = _resolve(rows)
            rows = {c: v[order] for c, v in rows.items()}
            rows["lo"], rows["hi"] = rows["lo"].astype(np.int64), rows["hi"].astype(np.int64)
            later = rows["id"] > least
            out = [(1, *x) for x in _dealt({c: v[later] for c, v in rows.items()}, _SPANS, rows["db"][later])]
            rows = _joined({c: v[~later] for c, v in rows.items()})
            out += [(0, *x) for x in _dealt(rows, _SUFFIXES, (rows["first"] % np.uint64(buckets)).astype(np.int64))]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary())], ["kind", "bucket", "blob"])

    return src.mapInArrow(run, "kind int, bucket int, blob binary")


def _joined(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Overlapping spans of one context in one document that follow each
    other at equal distances become one row: in periodic text a document
    repeats a context at every period. ``at`` is the first one's; ``more``
    others follow, each ``step`` bytes after the one before it."""
    if not len(rows["lo"]):
        return rows | {"step": rows["lo"], "more": rows["lo"]}
    keys = ("first", "second", "second_top", "id", "th")
    once = _starts(*(rows[c] for c in keys), rows["lo"])  # rows that are written twice
    rows = {c: v[once] for c, v in rows.items()}
    apart = _starts(*(rows[c] for c in keys))
    apart[1:] |= rows["lo"][1:] > rows["hi"][:-1]
    step = np.zeros(len(apart), np.int64)
    step[1:] = np.where(apart[1:], 0, np.diff(rows["lo"]))
    new = apart.copy()
    new[1:] |= ~apart[:-1] & (step[1:] != step[:-1])
    starts = np.flatnonzero(new)
    out = {c: v[starts] for c, v in rows.items()}
    out["hi"] = np.maximum.reduceat(rows["hi"], starts)
    out["more"] = np.diff(np.append(starts, len(new))) - 1
    out["step"] = np.where(out["more"] > 0, step[np.minimum(starts + 1, len(step) - 1)], 0)
    return out


def context_groups(drawn: DataFrame) -> DataFrame:
    """Buckets of suffixes become packed rows by document: 1, spans that
    repeat; 2, contexts of groups that the last digits must order; 3, those
    of groups with over ``HOT_CONTEXTS``, by part of a bucket. Spans that are known already pass
    through, so suffixes are hashed and moved once."""
    most = HOT_CONTEXTS

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() == 1:
            return pa.table({"kind": table.column("kind"), "db": table.column("bucket"), "blob": table.column("blob")})
        rows = _unpack(table.column("blob").to_pylist(), _SUFFIXES)
        order, least = _resolve(rows)
        rows = {c: v[order] for c, v in rows.items()}
        later = rows["id"] > least
        out = [(1, *x) for x in _dealt({c: v[later] for c, v in rows.items()}, _SPANS, rows["db"][later])]
        rows = {c: v[~later] for c, v in rows.items()}
        if len(rows["id"]):
            new = _starts(rows["first"])
            low = _least_in_group(new, rows["id"])
            high = -_least_in_group(new, -rows["id"])
            open_ = low != high  # contexts of several documents
            rows = {c: v[open_] for c, v in rows.items()}
            starts = np.flatnonzero(_starts(rows["first"])) if len(rows["id"]) else np.empty(0, np.int64)
            size = np.diff(np.append(starts, len(rows["id"])))
            hot = np.repeat(size > most, size)
            for kind, mine, to in ((2, ~hot, rows["db"]), (3, hot, rows["db"] * HOT_PARTS + rows["th"] % HOT_PARTS)):
                out += [(kind, *x) for x in _dealt({c: v[mine] for c, v in rows.items()}, _SUFFIXES, to[mine])]
        return pa.table({"kind": pa.array([x[0] for x in out], pa.int32()), "db": pa.array([x[1] for x in out], pa.int32()), "blob": pa.array([x[2] for x in out], pa.binary())})

    return drawn.groupBy("kind", "bucket").applyInArrow(run, "kind int, db int, blob binary")


def _packed_texts(src: DataFrame) -> DataFrame:
    """(db, id, th, text): texts compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for piece in tx.pieces(batches, "text"):
            texts = [pack.compress(x.as_buffer() if x.is_valid else b"") for x in piece.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([piece.column("db"), piece.column("id"), piece.column("th"), pa.array(texts, pa.binary())], ["db", "id", "th", "text"])

    return src.mapInArrow(run, "db int, id long, th long, text binary")


def _texts(table: pa.Table) -> Iterator[tuple[int, int, bytes]]:
    unpack = zstandard.ZstdDecompressor()
    for i, t, x in zip(table.column("id").to_pylist(), table.column("th").to_pylist(), table.column("text"), strict=True):
        yield i, t, unpack.decompress(x.as_py()) if len(x.as_buffer()) else b""


def _by_document(rows: dict[str, np.ndarray]) -> dict[tuple[int, int], slice]:
    """Slices of rows that are sorted by (id, th)."""
    return {(int(rows["id"][a]), int(rows["th"][a])): slice(a, b) for a, b in _runs(rows["id"], rows["th"])}


def _sorted(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    order = np.lexsort((rows["lo"], rows["th"], rows["id"]))
    return {c: v[order] for c, v in rows.items()}


def _bodies(docs: pa.Table, wanted: pa.Table, depth: int, k: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The wanted contexts of some documents, and their bytes."""
    reach = depth - k
    rows = _sorted(_unpack(wanted.column("blob").to_pylist(), _SUFFIXES))
    where = _by_document(rows)
    body = np.zeros((len(rows["id"]), reach + depth), np.uint8)
    lo, hi = rows["lo"].astype(np.int64), np.zeros(len(rows["id"]), np.int64)
    for i, t, text in _texts(docs) if where else ():
        own = where.get((i, t))
        if own is None:
            continue
        raw = np.frombuffer(text, np.uint8)
        for r in range(own.start, own.stop):
            at = int(rows["at"][r])
            a, b = max(0, at - reach), min(len(raw), at + depth)
            body[r, reach - (at - a) : reach + (b - at)] = raw[a:b]
            lo[r], hi[r] = a, b
    return rows | {"lo": lo, "hi": hi}, body


def hot_digits(texts: DataFrame, hot_contexts: DataFrame, depth: int, k: int) -> DataFrame:
    """Spans (packed by document) of windows that repeat inside groups with
    very many contexts: a row for each window, grouped by the window's hash."""
    most = HOT_CONTEXTS
    kinds = {"h0": np.int64, "h1": np.int64, "db": np.int32, "id": np.int64, "th": np.int64, "lo": np.int64, "hi": np.int64}

    def cut(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows, body = _bodies(docs, wanted, depth, k)
        out: dict[str, list[np.ndarray]] = {c: [np.empty(0, t)] for c, t in kinds.items()}
        for at in range(0, len(body), most):
            part = {c: v[at : at + most] for c, v in rows.items()}
            for offset, have, h in _window_hashes(part, body[at : at + most], depth, k):
                which = np.arange(len(have))
                own = {c: part[c][have] for c in (*_KEYS, "at", "step", "more")}
                many = np.repeat(which, _times(own, which, depth))
                own = _windows(own, which, offset, depth) | {"h0": h[0][many].view(np.int64), "h1": h[1][many].view(np.int64)}
                for c, t in kinds.items():
                    out[c].append(own[c].astype(t))
        return pa.table({c: pa.array(np.concatenate(v)) for c, v in out.items()})

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        rows = {c: table.column(c).to_numpy() for c in _SPANS}
        rows = _sorted(rows)
        doc = np.cumsum(_starts(rows["id"], rows["th"])) << 40  # spans that touch become one
        till = np.maximum.accumulate(doc + rows["hi"])
        new = np.ones(len(doc), bool)
        new[1:] = (doc + rows["lo"])[1:] > till[:-1]
        starts = np.flatnonzero(new)
        rows = {c: v[starts] for c, v in rows.items()} | {"hi": (till - doc)[np.append(starts[1:], len(doc)) - 1]}
        return pa.table({"db": pa.array([key[0].as_py()], pa.int32()), "blob": pa.array([_pack(rows, _SPANS, np.arange(len(starts)))], pa.binary())})

    part = F.pmod("th", F.lit(HOT_PARTS)).cast("int")
    wanted = materialise(hot_contexts.select("db").distinct(), "hot")
    texts = texts.withColumn("db", F.col("db") * HOT_PARTS + part).join(wanted, "db", "left_semi")
    windows = materialise(texts.groupBy("db").cogroup(hot_contexts.groupBy("db")).applyInArrow(cut, "h0 long, h1 long, db int, id long, th long, lo long, hi long"), "windows")
    least = windows.groupBy("h0", "h1").agg(F.min("id").alias("least"))
    late = windows.join(least, ["h0", "h1"]).where("id > least").select(*_SPANS)
    return late.groupBy("db", part).applyInArrow(packed, _CUT)


def last_digits(texts: DataFrame, open_contexts: DataFrame, depth: int, k: int, buckets: int) -> DataFrame:
    """Spans (packed by document) of windows that repeat inside groups with
    several contexts."""
    width = 2 * depth - k

    def cut(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[int, bytes, bytes]] = []
        rows, body = _bodies(docs, wanted, depth, k)
        bucket = (rows["first"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        pack = zstandard.ZstdCompressor(level=1)
        for a, b in _runs(bucket[order]):
            pick = order[a:b]
            out.append((int(bucket[pick[0]]), _pack(rows, _SUFFIXES, pick), pack.compress(body[pick].tobytes())))
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()), "blob": pa.array([x[1] for x in out], pa.binary()), "body": pa.array([x[2] for x in out], pa.binary())})

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        rows = _unpack(table.column("blob").to_pylist(), _SUFFIXES)
        unpack = zstandard.ZstdDecompressor()
        body = np.frombuffer(b"".join(unpack.decompress(x) for x in table.column("body").to_pylist()), np.uint8).reshape(-1, width)
        spans: list[dict[str, np.ndarray]] = []
        # in parts that keep groups whole: sorted by the first digit
        order = np.argsort(rows["first"], kind="stable")
        starts = np.flatnonzero(_starts(rows["first"][order])) if len(order) else np.empty(0, np.int64)
        at = 0
        while at < len(order):
            later = starts[starts >= at + HOT_CONTEXTS]
            to = int(later[0]) if len(later) else len(order)
            spans += _compared({c: v[order[at:to]] for c, v in rows.items()}, body[order[at:to]], depth, k)
            at = to
        found = {c: np.concatenate([s[c] for s in spans]) if spans else np.empty(0, t) for c, t in _SPANS.items()}
        out = list(_dealt(found, _SPANS, found["db"]))
        return pa.table({"db": pa.array([x[0] for x in out], pa.int32()), "blob": pa.array([x[1] for x in out], pa.binary())})

    cut_rows = texts.groupBy("db").cogroup(open_contexts.groupBy("db")).applyInArrow(cut, "bucket int, blob binary, body binary")
    return cut_rows.groupBy("bucket").applyInArrow(compare, _CUT)


def _window_hashes(rows: dict[str, np.ndarray], body: np.ndarray, depth: int, k: int) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """For each offset of the anchor: the rows that have the window, and the
    two halves of its hash."""
    reach = depth - k
    n = len(body)
    prefix = np.zeros((2, n, body.shape[1] + 1), np.uint64)
    for j in range(body.shape[1]):
        value = _TABLE[body[:, j]]
        prefix[0, :, j + 1] = prefix[0, :, j] * _P + value
        prefix[1, :, j + 1] = prefix[1, :, j] * np.uint64(0xD1342543DE82EF95) + (value >> np.uint64(7))
    powers = (_power(depth), np.uint64(pow(0xD1342543DE82EF95, depth, 1 << 64)))
    left = rows["at"].astype(np.int64) - rows["lo"].astype(np.int64)
    right = rows["hi"].astype(np.int64) - rows["at"].astype(np.int64)
    for offset in range(reach + 1):  # bytes of the window before the anchor
        have = np.flatnonzero((left >= offset) & (right >= depth - offset))
        a = reach - offset
        yield offset, have, [prefix[i, have, a + depth] - prefix[i, have, a] * powers[i] for i in (0, 1)]


def _compared(rows: dict[str, np.ndarray], body: np.ndarray, depth: int, k: int) -> list[dict[str, np.ndarray]]:
    """For each offset of the anchor: windows with equal bytes, and those in
    larger documents than the smallest."""
    out = []
    for offset, have, h in _window_hashes(rows, body, depth, k):
        if len(have) < 2:
            continue
        first, ids = rows["first"][have], rows["id"][have]
        order = np.lexsort((ids, h[1], h[0], first))
        least = _least_in_group(_starts(first[order], h[0][order], h[1][order]), ids[order])
        hit = have[order][ids[order] > least]
        if len(hit):
            out.append(_windows(rows, hit, offset, depth))
    return out


def _times(rows: dict[str, np.ndarray], hit: np.ndarray, depth: int) -> np.ndarray:
    """Spans of each row ``hit``: windows that follow closely make one."""
    return np.where(rows["step"][hit] > depth, rows["more"][hit].astype(np.int64) + 1, 1)


def _windows(rows: dict[str, np.ndarray], hit: np.ndarray, offset: int, depth: int) -> dict[str, np.ndarray]:
    """The windows ``offset`` bytes before the anchors of the rows ``hit``,
    at all places that the rows stand for."""
    step, more = rows["step"][hit].astype(np.int64), rows["more"][hit].astype(np.int64)
    each = _times(rows, hit, depth)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    hit, step, more = np.repeat(hit, each), np.repeat(step, each), np.repeat(more, each)
    lo = rows["at"][hit].astype(np.int64) - offset + nth * step
    return {c: rows[c][hit] for c in _KEYS} | {"lo": lo, "hi": lo + depth + np.where(step > depth, 0, more * step)}


def keep_rest(texts: DataFrame, spans: DataFrame, with_text: bool) -> DataFrame:
    """(id, th, n_bytes, n_removed, n_spans, kept_sha256[, kept]) per row."""

    def run(key: tuple, docs: pa.Table, wanted: pa.Table) -> pa.Table:
        rows = _sorted(_unpack(wanted.column("blob").to_pylist(), _SPANS))
        where = _by_document(rows)
        out: dict[str, list] = {x: [] for x in ("id", "th", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for i, t, text in _texts(docs):
            removed = runs = 0
            kept = text
            if (own := where.get((i, t))) is not None:
                edge = np.zeros(len(text) + 1, np.int32)
                np.add.at(edge, rows["lo"][own].astype(np.int64), 1)
                np.add.at(edge, rows["hi"][own].astype(np.int64), -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed, runs = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            for c, x in zip(out, (i, t, len(text), removed, runs, hashlib.sha256(kept).hexdigest(), kept if with_text else None), strict=True):
                out[c].append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        return pa.table({c: pa.array(out[c], k) for c, k in zip(out, kinds, strict=True)})

    return texts.groupBy("db").cogroup(spans.groupBy("db")).applyInArrow(run, "id long, th long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = 50, k: int | None = None, with_text: bool = False, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: bytes, removed bytes, maximal removed runs and
    the digest of the rest (``with_text``: and the rest, as bytes, since a
    cut may fall inside a character)."""
    k = k or max(4, depth * 2 // 5)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    ident = F.coalesce(docs[id_col].cast("long"), F.lit(int(_NO_ID)))
    th = F.xxhash64(docs[text_col], docs[id_col].isNull())
    src = docs.select(ident.alias("id"), th.alias("th"), F.pmod(F.xxhash64(ident, th), F.lit(buckets)).cast("int").alias("db"), docs[text_col].alias("text"))
    groups = materialise(context_groups(suffix_digits(src, depth, k, buckets)), "groups")
    texts = _packed_texts(src)
    late = last_digits(texts, groups.where("kind = 2").select("db", "blob"), depth, k, buckets)
    hot = groups.where("kind = 3").select("db", "blob")
    if not hot.isEmpty():
        late = late.union(hot_digits(texts, hot, depth, k))
    known = groups.where("kind = 1").select("db", "blob")
    out = keep_rest(texts, known.union(late), with_text)
    return out.select(F.when(F.col("id") != int(_NO_ID), F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else []))
