"""Distinct word shingles of a text as sorted 64-bit hashes.

A-Z are lower-cased and words are runs of characters other than space and
0x09-0x0D. Two different shingles share a hash with probability about 2^-64.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes hashed at once; a longer text is cut at white space.
BLOCK = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit; one for each salt."""
    x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        power = np.full(n, base, dtype=np.uint64)
        power[0] = 1
        out.append(np.multiply.accumulate(power))
    return out[0], out[1]


def _block_words(raw: np.ndarray) -> np.ndarray:
    word = ~_WHITE[raw]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    size = BLOCK + 1
    while size <= len(raw):
        size *= 2
    power, inverse = _powers(size)
    total = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_LOWER[raw] * power[: len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word, in order."""
    raw = np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
    if len(raw) <= BLOCK:
        return _block_words(raw)
    parts, start = [], 0
    while start < len(raw):
        stop = start + BLOCK
        while stop < len(raw) and not _WHITE[raw[stop]]:
            stop += 1
        parts.append(_block_words(raw[start:stop]))
        start = stop
    return np.concatenate(parts)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of the whole sequence if it is shorter.

    Null, empty and white texts have an empty set.
    """
    own = word_hashes(text or "")
    n = len(own)
    if not n:
        return own
    length = min(n, words)
    combined = np.full(n - length + 1, length, dtype=np.uint64)
    for i in range(length):
        combined += own[i : n - length + 1 + i] * np.uint64(_MASK & (2 * i + 1) * _BASE)
    return np.unique(mix(combined))
