"""Suffix arrays of byte strings in numpy: Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

FIRST = 7


def packed(data: np.ndarray) -> np.ndarray:
    """The FIRST bytes from each position on as one number, with zeros after the end."""
    padded = np.concatenate([data.astype(np.int64) + 1, np.zeros(FIRST, np.int64)])
    out = np.zeros(len(data), np.int64)
    for i in range(FIRST):
        out = out * 257 + padded[i : i + len(data)]
    return out


def _shared(new: np.ndarray) -> np.ndarray:
    """Whether an item has a neighbour of its own group; ``new`` tells where one follows another group."""
    return ~(np.append(True, new) & np.append(new, True))


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start positions in the order of their suffixes, and the place of each position.

    Suffixes with equal keys share a group; each round sorts only groups of more than one, by the group of the suffix
    that many bytes further on, so that the sorted length doubles.
    """
    n = len(data)
    key = packed(data)
    order = np.argsort(key, kind="stable")
    # The group of a suffix is the place of the group's last member.
    ordered = key[order]
    edge = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(edge, np.diff(edge, prepend=-1))
    reach = FIRST
    places = np.flatnonzero(_shared(ordered[1:] != ordered[:-1]))
    while len(places):
        open_ = order[places]
        after = np.where(open_ + reach < n, group[np.minimum(open_ + reach, n - 1)] + 1, 0)
        key = group[open_] * (n + 1) + after  # both in one number, sorted at once; a group keeps its places
        resort = np.argsort(key, kind="stable")
        open_, key = open_[resort], key[resort]
        order[places] = open_
        new = key[1:] != key[:-1]
        ends = np.flatnonzero(np.append(new, True))
        group[open_] = np.repeat(places[ends], np.diff(ends, prepend=-1))
        places = places[_shared(new)]
        reach *= 2
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def common_prefixes(data: np.ndarray, order: np.ndarray, place: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in order, at most ``depth``.

    Kasai's walk: going one byte on in the text loses one byte of the common prefix at most. The strings of a shard
    (``starts``) are walked side by side, one position of each at a time, and prefixes grow by packed words.
    """
    n = len(data)
    out = np.zeros(n, np.int64)
    if not n:
        return out
    words = np.concatenate([packed(data), np.zeros(depth + FIRST + 1, np.int64)])
    raw = np.concatenate([data.astype(np.int16), np.full(depth + FIRST + 1, -1, np.int16)])
    ends = np.append(starts[1:], n)
    alive = np.arange(len(starts))
    length = np.zeros(len(starts), np.int64)
    step = 0
    while len(alive):
        at = starts[alive] + step
        mine = length[alive]
        before = np.where(place[at] > 0, order[place[at] - 1], -1)
        going = np.flatnonzero(before >= 0)
        while len(going):  # whole words
            a, b = at[going] + mine[going], before[going] + mine[going]
            inside = (mine[going] < depth) & (a < n) & (b < n)
            same = inside & (words[np.minimum(a, n)] == words[np.minimum(b, n)])
            going = going[same]
            mine[going] += FIRST
        going = np.flatnonzero((before >= 0) & (mine < depth))
        for _ in range(FIRST):  # the last bytes
            a, b = at[going] + mine[going], before[going] + mine[going]
            same = (a < n) & (b < n) & (raw[np.minimum(a, n)] == raw[np.minimum(b, n)])
            going = going[same]
            mine[going] += 1
        mine = np.where(before >= 0, np.minimum(mine, depth), 0)
        out[place[at]] = mine
        length[alive] = np.maximum(mine - 1, 0)
        step += 1
        alive = alive[starts[alive] + step < ends[alive]]
    return out
