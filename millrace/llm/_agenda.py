"""Byte-pair merges of many short symbol sequences in lock step."""

from __future__ import annotations

import numpy as np

NONE = np.int64(1) << 60


class Merges:
    """Which pairs of symbols merge, into what, and which of them goes first (the lower rank; of equal ones the leftmost)."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        """pairs: (left, right) -> (rank, merged)."""
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.value = np.array([(r << 32) | to for r, to in pairs.values()], np.int64)[order]

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """rank << 32 | merged symbol of each pair, or NONE; negative symbols merge with nothing."""
        key = np.where((a >= 0) & (b >= 0), (a << 32) | np.maximum(b, 0), -1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.value[at], NONE)

    def run(self, sym: np.ndarray) -> None:
        """Merges the rows of ``sym`` in place; -1 ends a row, and the last column is -1."""
        width = sym.shape[1] - 1
        pair = self.of(sym[:, :-1], sym[:, 1:])
        rows = np.arange(len(sym))
        while len(rows):
            best = pair[rows].argmin(axis=1)
            low = pair[rows, best]
            go = low < NONE
            rows, best, low = rows[go], best[go], low[go]
            if not len(rows):
                break
            src = np.minimum(np.arange(width + 1) + (np.arange(width + 1) > best[:, None]), width)
            moved = np.take_along_axis(sym[rows], src, axis=1)
            at = np.arange(len(rows))
            moved[at, best] = low & 0xFFFFFFFF
            moved[:, width] = -1
            sym[rows] = moved
            p = np.take_along_axis(pair[rows], np.minimum(src[:, :-1], width - 1), axis=1)
            p[:, width - 1] = NONE
            p[at, best] = self.of(moved[at, best], moved[at, best + 1])
            prev = np.maximum(best - 1, 0)
            p[at, prev] = np.where(best > 0, self.of(moved[at, prev], moved[at, prev + 1]), p[at, prev])
            pair[rows] = p
