"""Order statistics of many windows over one sequence.

A window's k-th smallest value is found by walking the bits of the values' ranks: at each bit
a running count tells how many ranks of the window go either way.  The walk takes as many
steps as the sequence's length has bits, however many values the window holds, and no window
is ever laid out as an array.
"""

from __future__ import annotations

import numpy as np


class WindowRanks:
    """Ranks of a sequence of values, laid out so that any stretch can be asked for its k-th smallest."""

    def __init__(self, values: np.ndarray):
        order = np.argsort(values, kind="stable")
        self.sorted = values[order]
        ranks = np.empty(len(values), np.int32)
        ranks[order] = np.arange(len(values), dtype=np.int32)
        self.levels = []
        for bit in range(max(1, (len(values) - 1).bit_length()) - 1, -1, -1):
            ones = (ranks >> bit) & 1
            zeros = np.zeros(len(ranks) + 1, np.int32)
            np.cumsum(1 - ones, out=zeros[1:])
            self.levels.append((bit, zeros))
            ranks = np.concatenate([ranks[ones == 0], ranks[ones == 1]])

    def kth(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest (from 0) of the values ``lo`` to ``hi``, for many stretches at once; each has more than k."""
        lo, hi, k = lo.copy(), hi.copy(), k.copy()
        rank = np.zeros(len(lo), np.int64)
        for bit, zeros in self.levels:
            a, b = zeros[lo], zeros[hi]
            small = b - a
            right = k >= small
            rank |= right.astype(np.int64) << bit
            k -= np.where(right, small, 0)
            lo, hi = np.where(right, zeros[-1] + lo - a, a), np.where(right, zeros[-1] + hi - b, b)
        return self.sorted[rank]

    def quantile(self, lo: np.ndarray, hi: np.ndarray, q: float) -> np.ndarray:
        """Quantile with linear interpolation; every stretch has a value."""
        at = q * (hi - lo - 1)
        below = np.floor(at).astype(np.int64)
        a, b = self.kth(lo, hi, below), self.kth(lo, hi, np.ceil(at).astype(np.int64))
        return a + (b - a) * (at - below)

    def deviation(self, lo: np.ndarray, hi: np.ndarray, centre: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest distance (from 0) of a stretch's values from its ``centre``.

        The k + 1 nearest values stand side by side in sorted order.  Moving that run of
        values up, its lower end comes nearer and its upper end goes away, so the place where
        they are equally far is found by halving.
        """
        def ends(first):
            return centre - self.kth(lo, hi, first), self.kth(lo, hi, first + k) - centre

        least, most = np.zeros(len(lo), np.int64), hi - lo - 1 - k
        while (least < most).any():
            middle = (least + most) // 2
            down, up = ends(middle)
            least, most = np.where(up >= down, least, np.minimum(middle + 1, most)), np.where(up >= down, middle, most)
        before = np.maximum(least - 1, 0)
        return np.minimum(np.maximum(*ends(least)), np.maximum(*ends(before)))
