"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BYTES = np.random.default_rng(1234567).integers(1, 2**63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

# Classes of bytes: 0 stands between words, runs of any other class are words.
SPACES = np.ones(256, np.uint8)
SPACES[[0x20, *range(0x09, 0x0E)]] = 0
PUNCTUATED = np.full(256, 2, np.uint8)
PUNCTUATED[[*range(0x21), 0x7F]] = 0
PUNCTUATED[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd factor and of its inverse (modulo 2**64)."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            steps = np.full(size, np.uint64(base & _MASK))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers


def words(raw: bytes, classes: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word of a text; A-Z count as a-z."""
    data = LOWER[np.frombuffer(raw, dtype=np.uint8)]
    kinds = classes[data]
    starts = np.flatnonzero(np.diff(kinds, prepend=np.uint8(0)) != 0)
    ends = np.append(starts[1:], len(data))
    held = kinds[starts] > 0
    starts, ends = starts[held], ends[held]
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence if it is shorter, but not empty."""
    n = len(hashes)
    if n == 0:
        return hashes
    take = min(width, n)
    out = np.full(n - take + 1, np.uint64(take), np.uint64)
    for i in range(take):
        out = mix(out * np.uint64(_FACTOR) + hashes[i : n - take + 1 + i])
    return out
