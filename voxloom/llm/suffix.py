"""Suffix order and common prefixes of arrays of symbols, by prefix doubling on the positions that still repeat."""

from __future__ import annotations

import numpy as np


class SuffixRanks:
    """Ranks of the prefixes of 1, 2, 4, ... symbols at every position of an array.

    Two positions have equal ranks of a round exactly if so many symbols are the same there; so common prefixes, and common
    suffixes too, come by binary descent for whole arrays of position pairs.  Rounds end once no position repeats.
    """

    def __init__(self, symbols: np.ndarray):
        n = self.n = len(symbols)
        dense = np.unique(symbols, return_inverse=True)[1]
        counts = np.bincount(dense)
        # a rank is the place of its first member in suffix order, so a group splits without moving the others
        rank = (np.cumsum(counts) - counts)[dense]
        # a rank fits 32 bits up to two thousand million words; one document of n words that repeats throughout keeps log2(n) rounds of them
        small = np.int32 if n < 1 << 31 else np.int64
        self.rounds = [rank.astype(small)]
        #: For each round, the positions whose prefix of its length occurs elsewhere too, in ascending order.
        self.repeated = [np.flatnonzero(counts[dense] > 1)]
        active, k = self.repeated[0], 1
        while len(active):
            # the rank here, then the rank k further on; past the end comes first
            key = rank[active] * (n + 2) + np.where(active + k < n, rank[np.minimum(active + k, n - 1)] + 1, 0)
            by = np.argsort(key, kind="stable")
            key, at = key[by], active[by]
            group = rank[at]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            in_group = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
            sizes = np.diff(np.r_[head, len(at)])
            rank = rank.copy()
            rank[at] = group + np.repeat(in_group[head], sizes)
            self.rounds.append(rank.astype(small))
            active = np.sort(at[np.repeat(sizes, sizes) > 1])
            self.repeated.append(active)
            k *= 2

    def order(self, of: int = 0) -> np.ndarray:
        """In suffix order, the positions whose first ``2 ** of`` symbols occur elsewhere too."""
        at = self.repeated[of] if of < len(self.repeated) else np.zeros(0, np.int64)
        return at[np.argsort(self.rounds[-1][at], kind="stable")]

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that two different suffixes have in common, for arrays of their positions (0 to n)."""
        off = np.zeros(len(a), np.int64)
        for j in range(len(self.rounds) - 1, -1, -1):
            x, y = a + off, b + off
            ok = (x < self.n) & (y < self.n)
            ok[ok] = self.rounds[j][x[ok]] == self.rounds[j][y[ok]]
            off[ok] += 1 << j
        return off

    def common_suffix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Symbols that two different prefixes, which end before ``a`` and ``b``, have in common."""
        off = np.zeros(len(a), np.int64)
        for j in range(len(self.rounds) - 1, -1, -1):
            x, y = a - off - (1 << j), b - off - (1 << j)
            ok = (x >= 0) & (y >= 0)
            ok[ok] = self.rounds[j][x[ok]] == self.rounds[j][y[ok]]
            off[ok] += 1 << j
        return off
