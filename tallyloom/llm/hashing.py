"""Vectorised tokens and hashes over Arrow text columns (NumPy inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_STEPS = [U(0xD6E8FEB86659FD93), U(0xA0761D6478BD642F), U(0xE7037ED1A0B428DB), U(0x8EBC6AF09C88C6E3), U(0x589965CC75374CC3), U(0x1D8E4E27C47D124F), U(0xEB44ACCAB455D165), U(0x9FB21C651E98DF25)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n or more of each; one table per worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        size, out = 1 << max(16, (n - 1).bit_length()), []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, dtype=U)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[:] = out
    return _POWERS


_BYTE = mix(np.arange(1, 257, dtype=U))
_LOWER_BYTE = _BYTE[LOWER]


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int):
    """Row ranges (a, b) of whole texts with about ``limit`` bytes each; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, side="right")) - 1)
        yield a, min(b, n)
        a = b


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span [start, end)."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, U)
    np.cumsum((_LOWER_BYTE if lower else _BYTE)[raw] * up[:len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words [^\\x20\\x09-\\x0D]+ of the texts, and the offsets of the texts' first words."""
    solid = ~SPACE[raw]
    before = np.zeros(len(raw), bool)
    before[1:] = solid[:-1]
    edges = offsets[:-1][offsets[:-1] < len(raw)]
    before[edges] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.zeros(len(raw), bool)
    after[:-1] = solid[1:]
    inner = offsets[1:-1]
    after[inner[inner > 0] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of each text, with their offsets; a shorter text is one shingle, an empty one none."""
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    off = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=off[1:])
    at = np.arange(off[-1]) + np.repeat(first[:-1] - off[:-1], count)
    short = np.repeat((n < k) & (n > 0), count)
    out = np.zeros(len(at), U)
    end = np.repeat(first[1:], count)
    for j in range(k):
        p = at + j
        inside = p < end
        out += np.where(inside, hashes[np.minimum(p, max(len(hashes) - 1, 0))] * _STEPS[j % 8] + U(j + 1), U(0)) if len(hashes) else U(0)
    return mix(out + np.where(short, U(77), U(0))), off


def distinct_sorted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values inside each segment."""
    values = values.copy()
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    starts = offsets[:-1][np.diff(offsets) > 0]
    keep[starts] = True
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return values[keep], total[offsets]


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment; 0 for empty ones. Unsigned sums wrap."""
    out = np.zeros(len(offsets) - 1, values.dtype)
    full = np.diff(offsets) > 0
    if full.any():
        out[full] = np.add.reduceat(values, offsets[:-1][full])
    return out


def shingle_sets(column: pa.Array | pa.ChunkedArray, k: int, limit: int = 1 << 20):
    """Yield (a, b, hashes, offsets): the distinct shingle hashes, sorted, of the rows a..b of a text column."""
    raw, offsets = text_buffers(column)
    for a, b in slices(offsets, limit):
        lo, part = offsets[a], raw[offsets[a]:offsets[b]]
        starts, ends, first = words(part, offsets[a:b + 1] - lo)
        sh, off = shingle_hashes(span_hashes(part, starts, ends, lower=True), first, k)
        yield a, b, *distinct_sorted(sh, off)
