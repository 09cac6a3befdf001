"""Whole-text helpers over Arrow batches: tokens, word ids, hashes, segment sums.

A batch of texts is handled as one UTF-8 byte buffer with an offset per
text, so tokenising costs a few vector passes and no Python loop per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

PIECE_BYTES = 8 << 20

#: Words of class [^\x20\x09-\x0D]: everything but ASCII white space.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of class [^\x00-\x2F\x3A-\x60\x7B-\x7F], after lower-casing A-Z.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
#: Lower-cases A-Z and leaves every other byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` again, cut so that a piece holds about
    ``limit`` bytes of text (one longer text is a piece of its own)."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at, n = 0, batch.num_rows
        while at < n:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer and the n + 1 offsets of its texts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.empty(0, np.uint8)
    return buf, off - off[0]


def lookup(table: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """``table[buf]`` for a table of 256 one-byte entries, in one pass over
    the bytes."""
    return np.frombuffer(buf.tobytes().translate(table.tobytes()), table.dtype)


def tokens(buf: np.ndarray, off: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of ``word`` bytes, and the
    n + 1 token offsets of the texts. No token crosses a text's end."""
    inside = lookup(word, buf)
    cut = off[:-1][np.diff(off) > 0]
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_ids(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each token the index of its word, and the words (binary)."""
    if not len(starts):
        return np.empty(0, np.int64), pa.array([], pa.large_binary())
    lens = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] += 1
    edge[ends] -= 1  # a token may end where the next text's first one starts
    packed = buf[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(packed))])
    coded = arr.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word (the same on every machine)."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words.to_pylist()), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` consecutive word hashes (n - k + 1 of them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i : n + i]
    return mix(h)


def segment_sums(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def crc_mod(ids: pa.Array, n: int) -> np.ndarray:
    """crc32(id as text) mod ``n``; a null id counts as the empty text."""
    import zlib

    return np.fromiter((zlib.crc32(b"" if x is None else str(x).encode()) % n for x in ids.to_pylist()), np.int64, len(ids))


def parts(piece: pa.RecordBatch, text: str, cut: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Byte buffer and offsets of a piece, as ``text_bytes`` gives them. A
    text of more than ``limit`` bytes (a piece of its own) comes in several
    parts, each but the last ending with a byte of ``cut``, so that memory
    does not follow the text's length."""
    buf, off = text_bytes(piece.column(text))
    if piece.num_rows != 1 or len(buf) <= limit:
        yield buf, off
        return
    at = 0
    while at < len(buf):
        to = min(len(buf), at + limit)
        if to < len(buf):
            found = np.flatnonzero(cut[buf[at:to]])
            while not len(found) and to < len(buf):
                start, to = to, min(len(buf), to + limit)
                found = start - at + np.flatnonzero(cut[buf[start:to]])
            to = at + int(found[-1]) + 1 if len(found) else len(buf)
        yield buf[at:to], np.array([0, to - at], np.int64)
        at = to
