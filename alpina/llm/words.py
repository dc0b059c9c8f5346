"""Words of a text as 64-bit hashes, vectorised: lower-cased runs of letters and digits."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
_LETTER = np.zeros(0x110000, dtype=bool)
_ready = np.zeros(1, dtype=bool)


def _letters(points: np.ndarray) -> np.ndarray:
    if not _ready[0]:
        _LETTER[:0x30000] = [chr(c).isalnum() for c in range(0x30000)]
        _ready[0] = True
    return _LETTER[points]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shifts and odd multiplications), wrapping."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n-1 of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        m = max(n, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64)))):
            p = np.full(m, base, dtype=np.uint64)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(text: str) -> np.ndarray:
    """One hash per word, in text order."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return np.zeros(0, dtype=np.uint64)
    inside = np.zeros(len(points) + 2, dtype=bool)
    inside[1:-1] = _letters(points)
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    power, inverse = _power(len(points))
    total = np.zeros(len(points) + 1, dtype=np.uint64)
    np.cumsum(power * (points + np.uint64(1)), out=total[1:])
    return mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One hash per run of ``k`` words; a shorter text that has words is one shingle."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[i:i + n]
    return mix(out)
