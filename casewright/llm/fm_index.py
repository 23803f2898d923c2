"""A full-text index over integer tokens: suffix order, Burrows-Wheeler transform and wavelet matrix.

Everything is a numpy array and every query works on many patterns at once; counts are held for each place and level, so the
index of a shard trades memory for speed. The suffix order is that of the first ``depth`` tokens, which is all that
patterns of up to ``depth`` tokens can see.
"""

from __future__ import annotations

import numpy as np

DEPTH = 16


def suffix_order(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places of the text in the order of their first ``depth`` tokens, by doubling."""
    n = len(text)
    rank = text.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    reach = 1
    while reach < depth and n:
        behind = np.zeros(n, np.int64)
        behind[: n - reach] = rank[reach:] + 1
        key = rank * (int(rank.max()) + 2) + behind
        order = np.argsort(key, kind="stable")
        new = np.r_[False, key[order][1:] != key[order][:-1]]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        reach *= 2
    return order


class WaveletMatrix:
    """Counts of a symbol before a place, by one bit of the symbol at a time."""

    def __init__(self, symbols: np.ndarray, sigma: int) -> None:
        self.bits = max(1, int(sigma - 1).bit_length())
        self.zeros: list[np.ndarray] = []
        now = symbols
        for level in range(self.bits - 1, -1, -1):
            zero = (now >> level & 1) == 0
            before = np.zeros(len(now) + 1, np.int32)
            np.cumsum(zero, out=before[1:])
            self.zeros.append(before)
            now = np.concatenate([now[zero], now[~zero]])
        # Where each symbol begins in the last level.
        every = np.arange(sigma)
        self.begin = self._down(every, np.zeros(sigma, np.int64))

    def _down(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for level, before in zip(range(self.bits - 1, -1, -1), self.zeros, strict=True):
            one = (symbols >> level & 1).astype(bool)
            low = before[places]
            places = np.where(one, before[-1] + places - low, low)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        return self._down(symbols, places) - self.begin[symbols]


class FMIndex:
    """Backward search over a text of token numbers below ``sigma``."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int = DEPTH) -> None:
        self.order = suffix_order(text, depth)
        # The transform of the text as a ring: the token before each suffix.
        self.wavelet = WaveletMatrix(text[self.order - 1].astype(np.int64), sigma)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])[:-1]
        self.size = len(text)

    def widen(self, tokens: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the patterns with one more token in front."""
        return self.start[tokens] + self.wavelet.rank(tokens, low), self.start[tokens] + self.wavelet.rank(tokens, high)

    def matching(self, text: np.ndarray, ends: np.ndarray, most: int, least: int = 2) -> tuple[
            np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of the places ``ends`` of a streamed text: how many tokens, up to ``most``, that end before
        each place occur at least ``least`` times in the index; and the interval of the last such match."""
        length = np.zeros(len(ends), np.int64)
        low, high = np.zeros(len(ends), np.int64), np.full(len(ends), self.size)
        going = np.arange(len(ends))
        for step in range(1, most + 1):
            going = going[ends[going] >= step]
            if not len(going):
                break
            lo, hi = self.widen(text[ends[going] - step], low[going], high[going])
            enough = hi - lo >= least
            going = going[enough]
            low[going], high[going], length[going] = lo[enough], hi[enough], step
        return length, low, high
