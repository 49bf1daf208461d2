"""FM-index over word ids: wavelet-tree ranks, backward search, sampled suffixes."""

from __future__ import annotations

import numpy as np

from clickmarts.llm.suffix import suffix_array


class WaveletTree:
    """Rank and access over a sequence of small integers, a level per bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits = bits
        self.ones, self.zeros = [], []
        for b in range(bits - 1, -1, -1):
            bit = (values >> b) & 1
            ones = np.zeros(len(values) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(values) - int(ones[-1]))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before ``end``."""
        start = np.zeros_like(end)
        for b, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            one = ((symbol >> b) & 1).astype(bool)
            s, e = ones[start], ones[end]
            start, end = np.where(one, zeros + s, start - s), np.where(one, zeros + e, end - e)
        return end - start

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for ones, zeros in zip(self.ones, self.zeros):
            o = ones[at]
            bit = ones[at + 1] - o
            symbol = symbol * 2 + bit
            at = np.where(bit == 1, zeros + o, at - o)
        return symbol


class FmIndex:
    """Index of stretches of word ids (1..size), each ended by a 0.

    ``symbols`` ends with 0.  Ends of stretches sort before all words and among
    themselves by place, so that no suffix order reaches into the next stretch.
    Every 16th place and every start of a stretch is sampled, so that locating
    walks at most 15 steps and never over an end."""

    SAMPLE = 16

    def __init__(self, symbols: np.ndarray, size: int):
        ends = symbols == 0
        order = np.where(ends, np.cumsum(ends) - 1, symbols.astype(np.int64) + int(ends.sum()))
        sa, _ = suffix_array(order)
        self.tree = WaveletTree(symbols[sa - 1].astype(np.int64), max(1, int(size).bit_length()))
        self.first = np.r_[0, np.cumsum(np.bincount(symbols, minlength=size + 2))]
        starts = np.r_[True, ends[:-1]]
        sampled = (sa % self.SAMPLE == 0) | starts[sa]
        self.sampled, self.places = sampled, np.where(sampled, sa, -1)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases (rows padded by 0) at once: slot ranges."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.sampled), np.int64)
        for step in range(phrases.shape[1] if len(phrases) else 0):
            live = np.flatnonzero((lengths > step) & (low < high))
            symbol = phrases[live, lengths[live] - 1 - step]
            base = self.first[symbol]
            low[live], high[live] = (base + self.tree.rank(symbol, low[live]),
                                     base + self.tree.rank(symbol, high[live]))
        return low, np.maximum(low, high)

    def locate(self, slots: np.ndarray) -> np.ndarray:
        """Text places of the suffixes in ``slots``, stepping left to a sampled one."""
        places = np.zeros(len(slots), np.int64)
        steps, todo, at = 0, np.arange(len(slots)), slots.copy()
        while len(todo):
            found = self.sampled[at]
            places[todo[found]] = self.places[at[found]] + steps
            todo, at = todo[~found], at[~found]
            symbol = self.tree.access(at)
            at = self.first[symbol] + self.tree.rank(symbol, at)
            steps += 1
        return places
