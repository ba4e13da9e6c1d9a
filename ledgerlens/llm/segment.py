"""Byte-pair segmentation as a walk over prefixes.

The encoding of a word is determined pair by pair: a list of tokens is the byte-pair encoding of their concatenation
exactly when every token encodes to itself and every neighbouring pair encodes to that pair. So the last token of each
prefix follows from the last tokens of shorter prefixes, and one walk over the word gives the encoding of every prefix.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick

PAIRS_HELD = 300_000
NONE = -1


class Segmenter:
    """Walks words over a vocabulary of symbol strings (bytes as latin-1 characters).

    ``rank(a, b)`` is the priority of merging two neighbours (lower first, ties to the left), or None. A word may hold
    symbols of the vocabulary only.
    """

    def __init__(self, vocabulary: dict[str, int], rank: Callable[[str, str], int | None]):
        self.rank = rank
        self.names = {number: token for token, number in vocabulary.items()}
        self._fits: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for token, number in vocabulary.items():
            self.automaton.add_word(token, (number, len(token)))
        self.automaton.make_automaton()

    def merge(self, symbols: str) -> list[str]:
        """The byte-pair encoding by its definition: merge the best-ranked neighbours until none is left."""
        parts = list(symbols)
        ranks = [self.rank(a, b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best = min((r for r in ranks if r is not None), default=None)
            if best is None:
                return parts
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.rank(parts[at - 1], parts[at])
            if at < len(ranks):
                ranks[at] = self.rank(parts[at], parts[at + 1])

    def _check(self, left: int, right: int) -> bool:
        b = self.names[right]
        if left == NONE:
            known = self.merge(b) == [b]
        else:
            a = self.names[left]
            known = self.merge(a + b) == [a, b]
        if len(self._fits) >= PAIRS_HELD:
            self._fits.clear()
        self._fits[left, right] = known
        return known

    def walk(self, word: str) -> tuple[list[int], list[int]]:
        """For every prefix length: the last token of its encoding, and the number of tokens."""
        known, check = self._fits.get, self._check
        n = len(word)
        last, count = [NONE] * (n + 1), [0] * (n + 1)
        for end, (token, length) in self.automaton.iter(word):
            end += 1
            if last[end] < 0:
                begin = end - length
                before = last[begin]
                ok = known((before, token))
                if ok or ok is None and check(before, token):
                    last[end], count[end] = token, count[begin] + 1
        return last, count

    def tokens(self, word: str) -> list[int]:
        """The encoding of the whole word."""
        last, _ = self.walk(word)
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= len(self.names[last[end]])
        return out[::-1]
