"""Keys of 64-bit fingerprints from the binary Golay code (23, 12, 7).

The code is perfect: each 23-bit word lies within 3 bits of exactly one codeword,
found by its syndrome.  A word's key set holds the indices of the codewords
nearest to it and to its one-bit neighbours, at most 6.  Words up to 2 bits apart
share an index (that of a word between them); of two words 1 bit apart, each has
the other's nearest index in its set.

A fingerprint is cut in three segments.  Up to 4 differing bits leave one of:
(C) two equal segments; (A) one equal, another with 1 or 2 differing bits;
(B) none equal: two with exactly 1, the third with 1 or 2.  In B the words 1
bit apart have opposite parity, so the odd one gives its nearest index alone; and
one third of the third segment's bits is equal.  Keys of these three kinds therefore
meet for every pair within 4 bits.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

#: Fixed value: the generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1.
GENERATOR = 0b110001110101
WIDTHS = (22, 21, 21)                       # of the segments, from the lowest bit
STARTS = (0, 22, 43)


def _remainder(word: int) -> int:
    for bit in range(22, 10, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - 11)
    return word


_HIGH = np.array([_remainder(h << 11) for h in range(1 << 12)], np.int64)
_ERROR = np.zeros(1 << 11, np.int64)        # syndrome -> the error pattern of up to 3 bits
for _n in (1, 2, 3):
    for _bits in combinations(range(23), _n):
        _e = sum(1 << b for b in _bits)
        _ERROR[_remainder(_e)] = _e


def nearest(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword within 3 bits of each 23-bit word."""
    return (words ^ _ERROR[_HIGH[words >> 11] ^ (words & 0x7FF)]) >> 11


def key_sets(words: np.ndarray, n_bits: int) -> np.ndarray:
    """(n, 6) indices of the codewords near each word and its one-bit neighbours; -1 pads."""
    flips = np.r_[0, 1 << np.arange(n_bits, dtype=np.int64)]
    near = np.sort(nearest(words[:, None] ^ flips), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    out = np.full((len(words), 6), -1, np.int64)
    row, col = np.nonzero(new)
    out[row, (np.cumsum(new, axis=1) - 1)[row, col]] = near[row, col]
    return out


def fingerprint_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """uint64 fingerprints -> (position of the fingerprint, key as int64)."""
    seg = [((prints >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(STARTS, WIDTHS, strict=True)]
    full = [key_sets(x, w) for x, w in zip(seg, WIDTHS, strict=True)]
    lean = []
    for x, keys in zip(seg, full, strict=True):
        odd = (np.bitwise_count(x) & 1).astype(bool)
        k = keys.copy()
        k[odd, 0], k[odd, 1:] = nearest(x[odd]), -1
        lean.append(k)
    at, out = [], []

    def add(kind: int, keys: np.ndarray, valid: np.ndarray) -> None:
        row, col = np.nonzero(valid)
        at.append(row)
        out.append(keys[row, col] | (kind << 48))

    kind = 0
    for i, j in ((0, 1), (0, 2), (1, 2)):
        keys = (seg[i] << 22 | seg[j])[:, None]
        add(kind, keys, np.ones(keys.shape, bool))
        kind += 1
    for i in range(3):
        for j in range(3):
            if i != j:
                add(kind, seg[i][:, None] << 12 | full[j], full[j] >= 0)
                kind += 1
    for t in range(3):
        a, b = (lean[x] for x in range(3) if x != t)
        valid = ((a >= 0)[:, :, None] & (b >= 0)[:, None, :]).reshape(len(prints), -1)
        pair = (a[:, :, None] << 12 | b[:, None, :]).reshape(len(prints), -1)
        for part in range(3):
            third = seg[t] >> (7 * part) & (0xFF if WIDTHS[t] == 22 and part == 2 else 0x7F)
            add(kind, pair | (third << 24)[:, None], valid)
            kind += 1
    return np.concatenate(at), np.concatenate(out)
