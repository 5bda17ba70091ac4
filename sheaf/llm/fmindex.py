"""An FM-index over integer symbols, in numpy.

``FMIndex(text)`` holds the Burrows-Wheeler transform of ``text`` in a wavelet
matrix (one bit vector with rank counts per bit of a symbol) and every ``SAMPLE``-th
text position of its suffix array.  ``search`` narrows the suffix ranges of many
phrases at once, last symbol first; ``locate`` walks LF steps to sampled positions.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class Bits:
    """A bit vector with ``rank1(i)``: ones before position i."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(np.uint8)
        self.ones = np.zeros(len(bits) + 1, np.int32)
        np.cumsum(self.bits, out=self.ones[1:])

    def rank1(self, i: np.ndarray) -> np.ndarray:
        return self.ones[i]


class Wavelet:
    """A wavelet matrix: level by level, from the highest bit, zeros move before ones."""

    def __init__(self, symbols: np.ndarray, n_bits: int):
        self.levels: list[tuple[int, Bits, int]] = []
        now = symbols
        for b in range(n_bits - 1, -1, -1):
            bit = (now >> b) & 1
            bits = Bits(bit)
            self.levels.append((b, bits, len(now) - int(bits.ones[-1])))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before position ``i`` (arrays of equal length)."""
        lo, hi = np.zeros_like(i), i
        for b, bits, zeros in self.levels:
            one = ((symbol >> b) & 1).astype(bool)
            l1, h1 = bits.rank1(lo), bits.rank1(hi)
            lo, hi = np.where(one, zeros + l1, lo - l1), np.where(one, zeros + h1, hi - h1)
        return hi - lo

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at ``i`` and its rank there."""
        symbol, lo, at = np.zeros_like(i), np.zeros_like(i), i
        for b, bits, zeros in self.levels:
            one = bits.bits[at].astype(bool)
            l1, a1 = bits.rank1(lo), bits.rank1(at)
            lo, at = np.where(one, zeros + l1, lo - l1), np.where(one, zeros + a1, at - a1)
            symbol = symbol | (one.astype(symbol.dtype) << b)
        return symbol, at - lo


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By prefix doubling: ranks of 2k symbols from ranks of k, until all differ."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    key = text[order]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]]) if n else 0
    k = 1
    while n and rank.max() < n - 1:
        pair = rank * (n + 1)
        pair[: n - k] += rank[k:] + 1
        order = np.argsort(pair, kind="stable")
        key = pair[order]
        rank[order] = np.cumsum(np.r_[0, key[1:] != key[:-1]])
        k *= 2
    return order.astype(np.int64)


class FMIndex:
    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        """``text``: symbols of 1 or more; a 0 that ends the text is added here."""
        text = np.r_[np.asarray(text, np.int64), 0]
        self.n, self.sample = len(text), sample
        order = suffix_array(text)
        bwt = text[order - 1]
        self.top = int(text.max())
        self.first = np.r_[0, np.cumsum(np.bincount(text, minlength=self.top + 1))]
        self.wavelet = Wavelet(bwt, max(1, self.top.bit_length()))
        self.marked = Bits(order % sample == 0)
        self.positions = order[order % sample == 0]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges [lo, hi) of the phrases: rows of symbols, padded on the right."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            todo = np.flatnonzero((j < lengths) & (hi > lo))
            c = phrases[todo, j]
            known = (c > 0) & (c <= self.top)
            hi[todo[~known]] = lo[todo[~known]]
            todo, c = todo[known], c[known]
            lo[todo], hi[todo] = self.first[c] + self.wavelet.rank(c, lo[todo]), self.first[c] + self.wavelet.rank(c, hi[todo])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(self.marked.bits[rows] == 0)
        while len(walking):
            c, r = self.wavelet.access(rows[walking])
            rows[walking] = self.first[c] + r
            steps[walking] += 1
            walking = walking[self.marked.bits[rows[walking]] == 0]
        return self.positions[self.marked.rank1(rows)] + steps
