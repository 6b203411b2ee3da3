"""Vectorised work on Arrow text batches: slicing into blocks of bounded size,
rolling hashes of byte strings, sliding minima and word boundaries.

Everything here runs inside Spark tasks on one batch at a time, so memory is
bounded by the block size plus the longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that one block holds unless a single document is longer. The
#: arrays made of a block take some 100 times as much, and a worker's allocator
#: keeps that for its next tasks.
BLOCK_BYTES = 1 << 18
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads equal-distance inputs over all bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_VALUE = mix((np.arange(256, dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    if n > 1:
        out[1:] = U64(base)
        np.multiply.accumulate(out, out=out)
    return out


class Powers:
    """Powers of the hash base and of its inverse, grown on demand per task."""

    def __init__(self) -> None:
        self.up = _powers(_BASE, 1 << 16)
        self.down = _powers(_BASE_INV, 1 << 16)

    def need(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 2 * len(self.up))
            self.up, self.down = _powers(_BASE, size), _powers(_BASE_INV, size)


class RollingHash:
    """Hash of any substring of ``data`` in constant time (equal strings have
    equal hashes wherever they stand)."""

    def __init__(self, data: np.ndarray, powers: Powers) -> None:
        powers.need(len(data) + 1)
        self.powers = powers
        self.prefix = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTE_VALUE[data] * powers.up[: len(data)], out=self.prefix[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of every ``k`` consecutive bytes."""
        n = len(self.prefix) - k
        if n <= 0:
            return np.empty(0, U64)
        return mix((self.prefix[k:] - self.prefix[:n]) * self.powers.down[:n])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.powers.down[start])


def sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """For each window of ``w`` hashes, the position of its smallest (the
    leftmost among equals). Positions must fit 24 bits."""
    n = len(h) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = U64((1 << 24) - 1)
    key = np.full(-(-len(h) // w) * w, U64(_MASK))
    key[: len(h)] = (h & ~low) | np.arange(len(h), dtype=U64)
    rows = key.reshape(-1, w)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[w - 1:w - 1 + n]) & low).astype(np.int64)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a string column as ``(first, last, bytes, offsets)``; a null is
    an empty text. A block holds at most ``limit`` bytes or one document. At the
    column's end, what Arrow holds of earlier columns goes back to the system:
    a Python worker lives on, and its next task may need memory elsewhere."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.empty(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j
    pa.default_memory_pool().release_unused()


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of bytes for which the
    256-entry table ``in_word`` is true; runs end at document borders."""
    inside = in_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    if len(data):
        after[-1] = False
        after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    return start, end, doc
