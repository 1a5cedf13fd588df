"""Runs of bytes in Arrow text columns, with numpy inside a task. Only A-Z are lower-cased."""

from __future__ import annotations

import numpy as np

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of the runs of bytes marked ``inside``; none crosses from one row to the next."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(inside))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, ... of each range, one range after the other."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum()), dtype=np.int64) + np.repeat(start - first, size)
