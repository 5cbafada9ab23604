"""A compressed FM-index over word sequences: wavelet matrix of the transformed text, searched backward by arrays."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector in 64-bit words with a count before each word; ``ones(i)`` counts among the first i bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class Least:
    """Smallest value of any range of an array in about four numbers a value: prefix and suffix minima inside blocks, and
    a sparse table over the blocks' minima."""

    BLOCK = 16

    def __init__(self, values: np.ndarray):
        self.known, rank = np.unique(values, return_inverse=True)
        kind = np.min_scalar_type(len(self.known))
        rows = np.full((-(-len(values) // self.BLOCK), self.BLOCK), len(self.known), kind)
        rows.ravel()[: len(values)] = rank
        self.ranks = rows.ravel()
        self.from_left = np.minimum.accumulate(rows, axis=1).ravel()
        self.to_right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.tables, width = [rows.min(axis=1)], 1
        while 2 * width <= len(rows):
            a = self.tables[-1]
            self.tables.append(np.minimum(a[: len(a) - width], a[width:]))
            width *= 2

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The smallest value in each [low, high); ranges aren't empty."""
        last = high - 1
        first_block, last_block = low // self.BLOCK, last // self.BLOCK
        out = np.minimum(self.to_right[low], self.from_left[last])
        between = last_block - first_block - 1
        far = np.flatnonzero(between > 0)
        level = np.frexp(between[far].astype(np.float64))[1] - 1
        for k in np.unique(level):
            at, table = far[level == k], self.tables[k]
            inside = np.minimum(table[first_block[at] + 1], table[last_block[at] - (1 << int(k))])
            out[at] = np.minimum(out[at], inside)
        near = np.flatnonzero(between < 0)
        at, end = low[near], last[near]
        out[near] = self.ranks[at]
        while len(near):
            more = at < end
            near, at, end = near[more], at[more] + 1, end[more]
            out[near] = np.minimum(out[near], self.ranks[at])
        return self.known[out]


class FMIndex:
    """Index of sequences of positive symbols up to ``sigma``, each owned by a number; a search keeps, for many
    patterns at once, the range of suffixes that begin with what was read so far, and ``least`` gives the smallest
    owner in a range. It holds the transformed text's bits, a count for each 64 of them, and owners in ``Least``.
    Suffixes are ordered by their first ``DEPTH`` symbols, so patterns have fewer symbols."""

    DEPTH = 32

    def __init__(self, symbols: np.ndarray, begin: np.ndarray, owner: np.ndarray, sigma: int):
        """``begin`` has each sequence's first place in ``symbols`` and, last, their number."""
        n_seq = len(begin) - 1
        lengths = np.diff(begin)
        text = np.zeros(len(symbols) + n_seq, np.int64)
        seq = np.repeat(np.arange(n_seq), lengths)
        text[np.arange(len(symbols)) + seq] = symbols  # a zero ends each sequence
        own = np.repeat(owner, lengths + 1)
        n = self.n = len(text)
        rank, step = text.copy(), 1
        while step < self.DEPTH:
            nxt = np.zeros(n, np.int64)
            nxt[:-step] = rank[step:]
            key = rank * (int(rank.max()) + 1) + nxt
            order = np.argsort(key, kind="stable")
            new = np.zeros(n, np.int64)
            new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
            rank, step = new, 2 * step
        order = np.argsort(rank, kind="stable")
        last = text[order - 1]
        self.first = np.searchsorted(text[order], np.arange(sigma + 2))
        self.levels = max(1, int(sigma).bit_length())
        self.rows, self.zeros = [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (last >> level) & 1
            self.rows.append(Bits(bit.astype(bool)))
            self.zeros.append(int(n - bit.sum()))
            last = np.concatenate([last[bit == 0], last[bit == 1]])
        every = np.arange(sigma + 1)
        self.start = self._down(np.zeros(sigma + 1, np.int64), every)
        self.least = Least(own[order]).of

    def _down(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        for k, (row, zeros) in enumerate(zip(self.rows, self.zeros, strict=True)):
            ones = row.ones(at)
            bit = (symbol >> (self.levels - 1 - k)) & 1
            at = np.where(bit == 1, zeros + ones, at - ones)
        return at

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges after one more symbol in front of each pattern; empty where high <= low."""
        both = self._down(np.concatenate([low, high]), np.concatenate([symbol, symbol]))
        base = self.first[symbol] - self.start[symbol]
        return both[: len(low)] + base, both[len(low) :] + base

    def statistics(self, symbols: np.ndarray, begin: np.ndarray, length: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Matching statistics at the end of each pattern (``length`` symbols from ``begin``): how many of its last
        symbols occur together under an owner smaller than its own. The search reads backward and gives a pattern up
        once no suffix in its range has a smaller owner."""
        out = np.zeros(len(begin), np.int64)
        live = np.arange(len(begin))
        low, high = np.zeros(len(begin), np.int64), np.full(len(begin), self.n, np.int64)
        left = np.asarray(length, np.int64).copy()
        while len(live):
            low, high = self.extend(low, high, symbols[begin[live] + left - 1])
            ok = high > low
            live, low, high, left = live[ok], low[ok], high[ok], left[ok] - 1
            ok = self.least(low, high) < owner[live]
            out[live[ok]] += 1
            ok &= left > 0
            live, low, high, left = live[ok], low[ok], high[ok], left[ok]
        return out
