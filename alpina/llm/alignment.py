"""Banded alignment of many sequence pairs at once (unit costs)."""

from __future__ import annotations

import numpy as np

FIRST_BAND = 16
CELLS = 1 << 15


def _padded(seqs: list[np.ndarray], before: int, after: int, fill) -> np.ndarray:
    width = max(map(len, seqs))
    out = np.full((len(seqs), before + width + after), fill, dtype=np.int64)
    for i, s in enumerate(seqs):
        out[i, before:before + len(s)] = s
    return out


def _band_distance(a: list[np.ndarray], b: list[np.ndarray], w: int) -> np.ndarray:
    """Edit distances inside the band |i - j| <= w (exact where they are at most w)."""
    n, m = (np.array([len(s) for s in x]) for x in (a, b))
    rows = int(n.max())
    x = _padded(a, 0, 1, -1)
    y = _padded(b, w + 1, max(0, rows + w + 1 - int(m.max())) + w + 1, -2)
    k = np.arange(2 * w + 1)
    big = np.int64(1 << 30)
    cur = np.broadcast_to(np.where(k >= w, k - w, big), (len(a), 2 * w + 1)).copy()  # row 0: j = k - w
    out = np.full(len(a), big)
    rest = np.arange(len(a))

    def leave(i: int) -> None:
        done = n[rest] == i
        if done.any():
            p = rest[done]
            out[p] = cur[done, m[p] - n[p] + w]

    leave(0)
    for i in range(1, rows + 1):
        live = n[rest] >= i
        if not live.all():
            rest, cur = rest[live], cur[live]
        miss = y[rest, i:i + 2 * w + 1] != x[rest, i - 1][:, None]  # column j = i + k - w holds y[j - 1]
        nxt = cur + miss
        np.minimum(nxt[:, :-1], cur[:, 1:] + 1, out=nxt[:, :-1])
        if i <= w:
            nxt[:, :w - i] = big
            nxt[:, w - i] = i  # j = 0
        cur = np.minimum.accumulate(nxt - k, axis=1) + k
        leave(i)
        if i % 16 == 0:  # costs never fall again from row to row: above the band a pair is not settled here
            near = cur.min(axis=1) <= w
            if not near.all():
                rest, cur = rest[near], cur[near]
                if not len(rest):
                    break
    return out


def edit_distances(a: list[np.ndarray], b: list[np.ndarray], limits: np.ndarray) -> np.ndarray:
    """Edit distance of each pair, or limit + 1 where it is above the pair's limit.

    The band starts narrow and doubles for the pairs it does not settle, up to their limits."""
    limits = np.asarray(limits, dtype=np.int64)
    out = limits + 1
    gap = np.array([abs(len(x) - len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    todo = np.flatnonzero(gap <= limits)
    band = FIRST_BAND
    while len(todo):
        fits = todo[gap[todo] <= band]
        fits = fits[np.argsort([len(a[i]) for i in fits], kind="stable")]
        wide = set(todo.tolist()) - set(fits.tolist())
        step = max(1, CELLS // (2 * band + 1))
        for s in range(0, len(fits), step):
            part = fits[s:s + step]
            d = _band_distance([a[i] for i in part], [b[i] for i in part], band)
            settled = (d <= band) | (limits[part] <= band)
            out[part[settled]] = np.minimum(d, limits[part] + 1)[settled]
            wide |= set(part[~settled].tolist())
        todo = np.array(sorted(wide), dtype=np.int64)
        band *= 2
    return out
