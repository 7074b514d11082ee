"""A compressed FM-index over word symbols, as numpy arrays: BWT in a wavelet matrix of packed bits."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries over a sequence of small numbers: one packed bit vector with sampled counts per bit of the alphabet."""

    def __init__(self, seq: np.ndarray, sigma: int):
        n = len(seq)
        self.levels = []
        for bit in range(max(1, int(sigma - 1).bit_length()) - 1, -1, -1):
            ones = (seq >> bit) & 1 == 1
            packed = np.zeros(((n >> 6) + 1) * 8, np.uint8)
            bits = np.packbits(ones, bitorder="little")
            packed[: len(bits)] = bits
            words = packed.view("<u8")
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words)[:-1], out=before[1:])
            zeros = n - int(ones.sum())
            self.levels.append((bit, words, before, zeros))
            seq = np.concatenate([seq[~ones], seq[ones]])
        self.first = self._descend(np.arange(sigma), np.zeros(sigma, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, words, before, zeros in self.levels:
            block = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(words[block] & mask)
            at = np.where((symbol >> bit) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._descend(symbol, at) - self.first[symbol]


class FMIndex:
    """Index of a text of symbols (0 separates) for patterns of up to ``length`` symbols.

    Suffixes are sorted by their first ``length`` symbols, which is all that a
    backward search of that length compares.  For every interval of
    full-length matches the earliest text position is kept.
    """

    def __init__(self, text: np.ndarray, sigma: int, length: int):
        n = len(text)
        self.text, self.length = text, length
        rank, have = text.astype(np.int64), 1
        pad = lambda r, h: np.concatenate([r[h:], np.full(min(h, n), -1, np.int64)])[:n]
        shorter = None
        while have < length:
            step = min(have, length - have)
            if have + step == length:
                base, shorter = rank, (have, rank)
            key = (rank << 32) + (pad(rank, step) + 1)
            order = np.argsort(key, kind="stable")
            new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = new
            have += step
        self.suffixes = order
        row = np.arange(n)
        self._bounds = {}
        base_len, base = shorter
        by_row = rank[order]
        self._bounds[length] = self._classes(by_row[1:] != by_row[:-1], row)
        # prefixes one symbol shorter: equal when their first base_len and last base_len symbols are
        a, b = base[order], pad(base, length - 1 - base_len)[order]
        self._bounds[length - 1] = self._classes((a[1:] != a[:-1]) | (b[1:] != b[:-1]), row)
        lo = self._bounds[length][0]
        starts = np.flatnonzero(lo == row)
        self.earliest = np.repeat(np.minimum.reduceat(order, starts), np.diff(np.append(starts, n)))
        bwt = text[order - 1]
        bwt[order == 0] = 0
        self.bwt = WaveletMatrix(bwt, sigma)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma))])

    @staticmethod
    def _classes(new: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end of the class that holds each row; new[i]: row i + 1 begins a class."""
        starts = np.concatenate([[0], np.flatnonzero(new) + 1])
        sizes = np.diff(np.append(starts, len(row)))
        return np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)

    def matches(self, ends: np.ndarray, sizes: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics cut at ``length``: (query, offset) -> row interval of every full-length match.

        Queries are runs ``symbols[end - size:end]`` whose every ``length``
        symbols occur in the index.  All are streamed from their last symbol to
        the first together; the interval of a full-length match is widened to
        one symbol less before the next symbol is put in front of it.
        Returns for every window (in ``symbols`` positions) its start and its interval's first row.
        """
        order = np.argsort(-sizes, kind="stable")
        ends, sizes = ends[order], sizes[order]
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.text), np.int64)
        found_at, found_row = [], []
        wide_lo, wide_hi = self._bounds[self.length - 1]
        for step in range(int(sizes[0]) if len(sizes) else 0):
            m = int(np.searchsorted(-sizes, -step, "left"))  # queries longer than step
            lo, hi = lo[:m], hi[:m]
            if step >= self.length:
                lo, hi = wide_lo[lo], wide_hi[lo]
            c = symbols[ends[:m] - 1 - step]
            lo = self.before[c] + self.bwt.rank(c, lo)
            hi = self.before[c] + self.bwt.rank(c, hi)
            if step >= self.length - 1:
                found_at.append(ends[:m] - 1 - step)
                found_row.append(lo)
        none = np.zeros(0, np.int64)
        return np.concatenate([*found_at, none]), np.concatenate([*found_row, none])
