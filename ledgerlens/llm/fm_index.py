"""A full-text index over integer sequences in numpy: suffix order, wavelet ranks, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE_EVERY = 32


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by sorting on prefixes of doubling length."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:]
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        fresh = np.ones(n, np.int64)
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if n == 0 or rank[order[-1]] == n:
            return order
        width *= 2


class WaveletMatrix:
    """Counts of a symbol before a position, by one step for each bit of the symbol."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits = bits
        self.ones, self.zeros = [], []
        current = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((current >> level) & 1).astype(bool)
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]).astype(np.int32))
            self.zeros.append(int((~bit).sum()))
            current = np.concatenate([current[~bit], current[bit]])

    def rank(self, symbols: np.ndarray, *positions: np.ndarray) -> list[np.ndarray]:
        """For each array of positions: how often ``symbols[i]`` occurs before ``positions[i]``."""
        places = [np.zeros(len(symbols), np.int64), *[p.astype(np.int64) for p in positions]]
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = ((symbols >> (self.bits - 1 - level)) & 1).astype(bool)
            for i, place in enumerate(places):
                upto = ones[place]
                places[i] = np.where(bit, zeros + upto, place - upto)
        return [p - places[0] for p in places[1:]]


class FmIndex:
    """Index of one sequence of symbols from 0 to ``symbols_end`` - 1."""

    def __init__(self, symbols: np.ndarray, symbols_end: int):
        # A last symbol below all others ends the sequence.
        text = np.concatenate([symbols.astype(np.int64) + 1, [0]])
        order = suffix_order(text)
        before = text[order - 1]
        self.tree = WaveletMatrix(before, max(1, int(symbols_end).bit_length()))
        self.before = before
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols_end + 1))])
        self.size = len(text)
        sampled = order % SAMPLE_EVERY == 0
        self.sampled = sampled
        self.sampled_before = np.concatenate([[0], np.cumsum(sampled)])
        self.positions = order[sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of phrases that occur, and their ranges of suffixes (from, to), by searching from the last symbol back."""
        alive = np.arange(len(phrases))
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column].astype(np.int64) + 1
            below, upto = self.tree.rank(symbol, low, high)
            low, high = self.smaller[symbol] + below, self.smaller[symbol] + upto
            found = low < high
            alive, low, high = alive[found], low[found], high[found]
        return alive, low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by stepping back to the next sampled one."""
        out = np.empty(len(rows), np.int64)
        pending, current, steps = np.arange(len(rows)), rows.astype(np.int64), 0
        while len(pending):
            known = self.sampled[current]
            out[pending[known]] = self.positions[self.sampled_before[current[known]]] + steps
            pending, current = pending[~known], current[~known]
            symbol = self.before[current]
            current = self.smaller[symbol] + self.tree.rank(symbol, current)[0]
            steps += 1
        return out
