"""Vectorised hashing of words, bytes and windows over Arrow batches (helpers for tasks).

All hashes are functions of content alone and the same on every machine.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.Generator(np.random.PCG64(20240917))
#: a random 64-bit value per byte
BYTE_HASH = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
_MULT = _RNG.integers(1, 1 << 62, 64, dtype=np.uint64) * U(4) + U(1)
_POWER_BASE = int(_MULT[63])
_POWER_INVERSE = pow(_POWER_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

CHUNK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and each row's start in them, with the end as last; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(column) else np.empty(0, np.uint8)
    return data, (offsets - offsets[0] if len(column) else np.zeros(1, np.int64))


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, rows: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (bytes not ``apart``), and the number of words before each row (with the total as last)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(rows), np.int64)
    solid = ~apart[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = False
    edge[rows] = True
    first = solid & (edge[:-1] | ~np.concatenate([[False], solid[:-1]]))
    last = solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, rows)


def _powers(n: int, base: int, store: dict = {}) -> np.ndarray:  # noqa: B006
    have = store.get(base)
    if have is None or len(have) < n:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        have = store[base] = np.multiply.accumulate(out)
    return have[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK)))
        a, b = int(starts[i]), int(ends[j - 1])
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(BYTE_HASH[data[a:b]] * _powers(max(b - a, CHUNK), _POWER_BASE)[:b - a], out=sums[1:])
        out[i:j] = (sums[ends[i:j] - a] - sums[starts[i:j] - a]) * _powers(max(b - a + 1, CHUNK), _POWER_INVERSE)[starts[i:j] - a]
        i = j
    return mix(out + (ends - starts).astype(np.uint64))


def gram_hashes(items: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` items from each position on (positions with fewer items left are dropped)."""
    n = len(items) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    level, size, out, done, bit = items, 1, None, 0, 0
    while True:
        if k & size:
            part = level[done:done + n]
            out = part.copy() if out is None else (out ^ (out >> U(29))) * _MULT[32 + bit] + part
            done += size
        if size * 2 > k:
            return out
        level = (level[:-size] ^ (level[:-size] >> U(31))) * _MULT[bit] + level[size:]
        size, bit = size * 2, bit + 1


def sliding_argmin(keys: np.ndarray, w: int) -> np.ndarray:
    """Position of the least key among each ``w`` neighbours, the leftmost of equals (by the keys' upper 43 bits)."""
    n, out = len(keys) - w + 1, []
    step = (1 << 21) - w
    for at in range(0, max(n, 0), step):
        part = keys[at:at + step + w - 1]
        place = np.arange(len(part), dtype=np.uint64)
        m, size = (part >> U(21) << U(21)) | place, 1
        while size * 2 <= w:
            m = np.minimum(m[:-size], m[size:])
            size *= 2
        if size < w:
            m = np.minimum(m[:len(part) - w + 1], m[w - size:w - size + len(part) - w + 1])
        out.append((m & U((1 << 21) - 1)).astype(np.int64) + at)
    return np.concatenate(out) if out else np.empty(0, np.int64)


class Anchors:
    """Minimizer anchors of all windows of ``window`` items that stay within a row.

    Each window belongs to the position of its least ``k``-gram, so equal
    windows belong to equal grams at equal distances. An anchor owns the
    consecutive windows ``first..last`` (positions of their first items).
    """

    def __init__(self, items: np.ndarray, rows: np.ndarray, window: int, k: int):
        w = window - k + 1
        self.rows, self.window, self.k = rows, window, k
        self.grams = grams = gram_hashes(items, k)
        at = sliding_argmin(mix(grams), w)
        size = rows[1:] - rows[:-1]
        valid = np.zeros(len(at) + 1, np.int64)  # windows within one row
        long = size >= window
        np.add.at(valid, rows[:-1][long], 1)
        np.add.at(valid, np.minimum(rows[1:][long] - window + 1, len(at)), -1)
        valid = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
        at = at[valid]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)
        head = np.flatnonzero(new)
        self.at, self.first = at[head], valid[head]
        self.last = valid[np.concatenate([head[1:], [len(at)]]) - 1] if len(at) else valid
        self.row = np.searchsorted(rows, self.at, side="right") - 1

    def gram(self) -> np.ndarray:
        return mix(self.grams[self.at])

    def context(self) -> np.ndarray:
        """Hash of all items of the owned windows and of the anchor's place among them."""
        out = (self.at - self.first).astype(np.uint64) * _MULT[50] + (self.last - self.first).astype(np.uint64)
        steps = [*range(0, self.window - self.k, self.k), self.window - self.k]
        for base in (self.first, self.last):
            for s in steps:
                out = mix(out) * _MULT[51] + self.grams[base + s]
        return mix(out)


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    head = np.concatenate([[True], starts[1:] > reach[:-1]])
    at = np.flatnonzero(head)
    return starts[at], reach[np.concatenate([at[1:], [len(starts)]]) - 1]
