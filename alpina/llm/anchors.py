"""Content-defined anchors: every ``length``-byte window contains the anchor it is filed under.

The anchor of a window is the ``GRAM``-byte string in it with the smallest hash (the leftmost of equal ones), so
equal windows have equal anchors at equal offsets, wherever they stand. Neighbouring windows mostly share
theirs: about 3 % of the positions are anchors of 100-byte windows.
"""

from __future__ import annotations

import numpy as np

GRAM = 32
PIECE = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, dtype=np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM (a power of two) bytes from each position."""
    h, step, power = _BYTES[data], 1, _BASE
    while step < GRAM:
        h = h[:-step] * np.uint64(power) + h[step:]
        step, power = 2 * step, power * power % (1 << 64)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` neighbouring values (prefix and suffix minima of blocks of w)."""
    n = len(x) - w + 1
    wide = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, dtype=x.dtype)
    wide[:len(x)] = x
    blocks = wide.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1:w - 1 + n])


def segments(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, over texts laid end to end (``starts``: where each begins, and the end).

    (text, first window, windows, anchor hash, hash of the bytes they cover) per run; places count from the
    text's start. ``data`` must be shorter than 2^24."""
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    h = gram_hashes(data)
    ranked = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    anchor = (window_minima(ranked, length - GRAM + 1) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:len(anchor)]
    inside = np.arange(len(anchor)) + length <= starts[1:][text]
    change = np.r_[True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]
    first = np.flatnonzero(change & inside)
    last_of_run = np.flatnonzero(inside & np.r_[change[1:] | ~inside[1:], True])
    count = last_of_run - first + 1
    power = np.full(len(data) + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(data) + 1, _INVERSE, dtype=np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.r_[np.uint64(0), np.cumsum(_BYTES[data] * power[:-1], dtype=np.uint64)]
    cover = (total[first + count - 1 + length] - total[first]) * back[first]
    cover ^= cover >> np.uint64(29)
    cover *= np.uint64(0xA0761D6478BD642F)
    cover ^= cover >> np.uint64(32)
    return text[first], first - starts[text[first]], count, h[anchor[first]], cover + count.astype(np.uint64)
