"""A compressed full-text index over word numbers, with backward search.

The index is the Burrows-Wheeler transform of the text in a wavelet matrix:
one bit vector a bit of the word numbers, packed, with a rank directory of one
count per 64 bits.  Suffixes are sorted to ``depth`` words, enough for the
patterns searched (a pattern's interval depends on that order only up to its
own length).
"""

from __future__ import annotations

import numpy as np


class BitVector:
    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(counts, dtype=np.int32) - counts

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class FmIndex:
    """``text``: numbers from 0; 0 separates the parts of the text and is in no pattern."""

    def __init__(self, text: np.ndarray, depth: int = 32):
        text = np.asarray(text, np.int64)
        n = len(text)
        self.n, self.text, self.depth = n, text, depth
        rank, k = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
        while k < depth:                                           # double the sorted length
            second = np.zeros(n, np.int64)
            second[:max(n - k, 0)] = rank[k:] + 1
            rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64)
            k *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        counts = np.bincount(text, minlength=int(text.max(initial=0)) + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        row = text[self.suffixes - 1]                              # the transform: the word before each suffix
        self.levels, self.zeros = [], []
        for bit in reversed(range(max(1, int(text.max(initial=1)).bit_length()))):
            ones = row >> bit & 1
            self.levels.append((bit, BitVector(ones.astype(np.uint8))))
            self.zeros.append(int(n - ones.sum()))
            row = np.concatenate([row[ones == 0], row[ones == 1]])
        words = np.arange(len(self.first) - 1)
        self.begin = self._descend(words, np.zeros(len(words), np.int64))

    def _descend(self, word: np.ndarray, i: np.ndarray) -> np.ndarray:
        for (bit, vector), zeros in zip(self.levels, self.zeros):
            r = vector.rank(i)
            i = np.where(word >> bit & 1, zeros + r, i - r)
        return i

    def before(self, word: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of the patterns with ``word`` put in front."""
        at = self._descend(np.concatenate([word, word]), np.concatenate([lo, hi]))
        at = at - np.concatenate([self.begin[word], self.begin[word]]) + np.concatenate([self.first[word], self.first[word]])
        return at[:len(word)], at[len(word):]

    def matching_statistics(self, ends: np.ndarray, longest: int, occurrences: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text position: how many words up to and with it (``longest``
        at most) occur ``occurrences`` times at least, and the interval of
        suffixes of those that reach ``longest``: (lengths, lo, hi)."""
        lengths = np.zeros(len(ends), np.int64)
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        live = np.arange(len(ends))
        for step in range(longest):
            at = ends[live] - step
            word = np.where(at >= 0, self.text[at], 0)
            a, b = self.before(word, lo[live], hi[live])
            good = (word > 0) & (b - a >= occurrences)
            live, a, b = live[good], a[good], b[good]
            lo[live], hi[live] = a, b
            lengths[live] = step + 1
        return lengths, lo, hi
