"""Words, their hashes and shingles of Arrow text columns, with numpy inside a task.

Texts are taken as UTF-8 bytes. A word is a run of bytes other than space and 0x09-0x0D;
A-Z count as a-z. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER] | np.uint64(1)
_RADIX = 0x9E3779B97F4A7C15 | 1
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)
_power = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each hash (the finaliser of a split-mix generator)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        grown = np.full(max(64, 2 * n), np.uint64(_RADIX), np.uint64)
        grown[0] = 1
        _power = np.multiply.accumulate(grown)
    return _power


@dataclass
class Words:
    """Words of consecutive rows: byte ranges in ``data``, hashes, and the row of each word."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def first(self) -> np.ndarray:
        """Index of the first word of each row, and the number of words at the end."""
        return np.searchsorted(self.row, np.arange(self.rows + 1))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with about ``limit`` bytes; null is empty."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range (none empty), in bounded pieces."""
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + SLICE_BYTES, "right")))
        size = end[lo:hi] - start[lo:hi]
        first = np.cumsum(size) - size
        at = np.arange(int(size.sum()), dtype=np.int64)
        place = at - np.repeat(first, size)
        values = _VALUE[data[place + np.repeat(start[lo:hi], size)]] * _powers(int(size.max()))[place]
        out[lo:hi] = mixed(np.add.reduceat(values, first) + size.astype(np.uint64) * _STEP)
        lo = hi
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of rows given by ``offsets`` into ``data``."""
    inside = ~_BREAK[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    return Words(data, offsets, start, end, row, hashed(data, start, end))


def joined(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` neighbours."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n] * _STEP
    for j in range(1, k):
        out = (out + hashes[j : j + n]) * _STEP
    return mixed(out + np.uint64(k))


def shingles(w: Words, k: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its runs of ``k`` words; of all its words if it has fewer."""
    first = w.first()
    runs = joined(w.hash, k)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        own = runs[a : b - k + 1] if b - a >= k else joined(w.hash[a:b], b - a) if b > a else runs[:0]
        own = np.sort(own)
        out.append(own[np.concatenate(([True], own[1:] != own[:-1]))] if len(own) > 1 else own)
    return out
