"""Numpy helpers over the UTF-8 buffers of Arrow text columns.

All hashes are 64-bit polynomial prefix hashes (random byte table, odd base,
arithmetic modulo 2**64, a final mixing step), so the hash of any substring
or run of words is one subtraction and one product. Equal content gives
equal hashes; different content collides with a chance of about 2**-64.
Nothing here keeps state between batches.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 19
_BASE = U(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = U(pow(int(_BASE), -1, 1 << 64))

#: White space between words: blank and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = np.asarray(x, U).copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_POW = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW[0]) < n:
        for k, b in enumerate((_BASE, _INV)):
            p = np.full(max(n, 1 << 16), b, U)
            p[0] = 1
            _POW[k] = np.cumprod(p, dtype=U)
    return _POW[0][:n], _POW[1][:n]


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.fill_null("") if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else col.fill_null(b"")
    width = np.int64 if str(col.type).startswith("large") else np.int32
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], width, len(col) + 1, col.offset * np.dtype(width).itemsize).astype(np.int64) if len(col) else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data, off


def slices(off: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of about ``limit`` bytes (one row at least), so temporary
    arrays stay small whatever the batch size is."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


class Prefix:
    """Hashes of any range ``[s, e)`` of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * _powers(len(values))[0], dtype=U, out=self.sums[1:])
        self.inv = _powers(len(values) + 1)[1]

    def span(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self.sums[e] - self.sums[s]) * self.inv[s] + (e - s).astype(U) * U(0xA24BAED4963EE407))


def byte_prefix(data: np.ndarray, family: int = 0) -> Prefix:
    return Prefix(_BYTE[data] if not family else mix(_BYTE ^ U(family))[data])


def words(data: np.ndarray, off: np.ndarray):
    """Word starts and ends (byte positions) and, per row, the index of its
    first word (one more entry than rows). ``off`` starts at 0 and ends at
    ``len(data)``."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    sp = SPACE[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, sp[:-1]
    before[off[:-1][off[:-1] < len(data)]] = True
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, sp[1:]
    after[off[1:][off[1:] > 0] - 1] = True
    starts = np.flatnonzero(~sp & before)
    ends = np.flatnonzero(~sp & after) + 1
    return starts, ends, np.searchsorted(starts, off)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of every item, given item bounds per row."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def room(bounds: np.ndarray) -> np.ndarray:
    """For each item, how many items of its row start at or after it."""
    return np.repeat(bounds[1:], np.diff(bounds)) - np.arange(bounds[-1])


def lowest(keys: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest key (its upper 32 bits; ties: the first) in
    each window of ``width`` keys; one entry for each window."""
    n = len(keys)
    if n < width:
        return np.zeros(0, np.int64)
    v = (keys >> U(32) << U(32)) | np.arange(n, dtype=U)
    pad = -n % width
    v = np.concatenate([v, np.full(pad, np.iinfo(U).max, U)]).reshape(-1, width)
    fwd = np.minimum.accumulate(v, 1).ravel()
    bwd = np.minimum.accumulate(v[:, ::-1], 1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(bwd[:m], fwd[width - 1:width - 1 + m]) & U(0xFFFFFFFF)).astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i]+1, …`` (``counts[i]`` of them), joined."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.repeat(starts - first, counts) + np.arange(total)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
