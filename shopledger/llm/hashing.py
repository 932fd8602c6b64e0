"""Vectorised hashing of bytes, words and shingles with numpy.

All functions work on one batch of texts laid end to end, so their cost per byte
does not depend on how the bytes are cut into texts. Hashes are 64 bits wide,
the same in every process and on every machine.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1

# White space is what the contracts name: 0x20 and 0x09 to 0x0D.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values: a fixed bijection of [0, 2**64)."""
    x = values.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def mix_int(value: int) -> int:
    return int(mix(np.array([value & _MASK], dtype=_U64))[0])


_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        table = np.full(size, base, dtype=_U64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[base] = table
    return table[:n]


class Rolling:
    """Hashes of any byte ranges of one buffer, in constant time each."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self._sums = np.zeros(n + 1, dtype=_U64)
        np.cumsum((data.astype(_U64) + _U64(1)) * _power_table(_BASE, n), out=self._sums[1:])
        self._inverse = _power_table(_BASE_INVERSE, n + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes in [start, end) for every pair."""
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])

    def windows(self, size: int) -> np.ndarray:
        """Hash of every window of ``size`` bytes, by its start."""
        n = len(self._sums) - size
        if n <= 0:
            return np.zeros(0, dtype=_U64)
        return mix((self._sums[size:] - self._sums[:n]) * self._inverse[:n])


def joined(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end, and where each starts, with the end at last."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(b"".join(texts), dtype=np.uint8), offsets


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the number of words before
    each text, with the total at last. No word spans two texts."""
    # A blank after each text keeps the last word of one from the first of the next.
    data, offsets = joined([part for t in texts for part in (t, b" ")])
    data = _LOWER[data]
    inside = np.empty(len(data) + 1, dtype=bool)
    inside[0] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = turns[0::2], turns[1::2]
    hashes = Rolling(data).ranges(start, end) if len(start) else np.zeros(0, dtype=_U64)
    return hashes, np.searchsorted(start, offsets[0::2])


def shingle_sets(texts: Sequence[bytes], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words.
    A shorter text has one shingle, its whole sequence; without words, none."""
    hashes, firsts = word_hashes(texts)
    salt = [_U64(mix_int(i + 1) | 1) for i in range(words)]
    n = max(0, len(hashes) - words + 1)
    runs = np.zeros(n, dtype=_U64)
    for i in range(words):
        runs += hashes[i : i + n] * salt[i]
    runs = mix(runs)
    sets = []
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        count = b - a
        if count >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        elif count:
            whole = sum(int(h) * int(s) for h, s in zip(hashes[a:b], salt, strict=False))
            sets.append(np.array([mix_int(whole + int(count))], dtype=_U64))
        else:
            sets.append(np.zeros(0, dtype=_U64))
    return sets
