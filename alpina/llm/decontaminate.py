"""Benchmark decontamination by the q-gram lemma.

Texts and items are compared in lower case with runs of white space as one space. An item of m characters
counts as leaked where a passage of the text is within ``e = EDIT_RATE * m`` edits of it. Such a passage
shares at least ``m - q + 1 - q * e`` character q-grams with the item, on at most e + 1 neighbouring
diagonals (text position minus item position). ``q`` is 10, or 8 for items whose bound would not be positive with 10. So q-gram hits are counted in diagonal bands of width
2 (e + 1) that overlap by half, bands that meet the bound are kept, and each is verified by a banded
alignment of the whole item.

The items' q-gram index is broadcast in blocks of at most ``BLOCK_CHARS`` characters; the documents are read
once per block and nothing of them is shuffled. The driver holds the items of one block at a time.

Defined results: null and empty texts hold no passage; null items and items of at most ``WORD_CHARS`` characters (no
passage, but a word or two that stands in many clean texts) match nothing; equal items report each; rows repeating an id report each;
very long texts are searched whole; empty tables give no rows. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from alpina.llm.common import packed, unpacked

GRAMS = (10, 8)
WORD_CHARS = 10
EDIT_RATE = 0.06
BLOCK_CHARS = 4 << 20
FILTER_BITS = 22
HITS = "doc_id long, item_id long, start long, end long, edits int, shared_qgrams int"
_ORIGIN = 1 << 31  # added to diagonals: keys stay positive for items and texts below 2^31 characters
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(0x110000, dtype=bool)
_SPACES[[c for c in range(0x3001) if chr(c).isspace()]] = True


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points in lower case with single spaces, and the place of each in the text."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = _SPACES[points]
    drop = space.copy()
    drop[1:] &= space[:-1]
    drop[:1] = space[:1]
    at = np.flatnonzero(~drop)
    out = points[at]
    out[space[at]] = 32
    if len(out) and out[-1] == 32:
        out, at = out[:-1], at[:-1]
    return out, at


def gram_hashes(points: np.ndarray, q: int = GRAMS[0]) -> np.ndarray:
    """Polynomial hashes of all q-grams (q is 8 or 10), built from those of 2, 4 and 8 characters."""
    n = len(points) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = points.astype(np.uint64)
    h += np.uint64(1)
    pairs, step, power = None, 1, _BASE
    while step < 8:
        h = h[:-step] * np.uint64(power) + h[step:]
        pairs = h if pairs is None else pairs
        step, power = 2 * step, power * power % (1 << 64)
    if q == 10:
        h = h[:n] * np.uint64(_BASE * _BASE % (1 << 64)) + pairs[8:8 + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def gram_size(length: int) -> int:
    """The largest q whose lemma asks an item of this length for at least one shared q-gram."""
    e = int(length * EDIT_RATE)
    return next(q for q in GRAMS if length - q + 1 - q * e > 0)


def build_index(items: list[tuple[int, str]]) -> list[dict]:
    """Per q an index of the items that use it."""
    parts: dict[int, list[tuple[int, np.ndarray]]] = {}
    for item_id, text in items:
        points = normalised(text)[0]
        if len(points) > WORD_CHARS:
            parts.setdefault(gram_size(len(points)), []).append((item_id, points))
    return [_gram_index(q, found) for q, found in sorted(parts.items())]


def _gram_index(q: int, items: list[tuple[int, np.ndarray]]) -> dict:
    """Sorted q-gram hashes with their (item, position) lists, and a bit filter over the hashes."""
    points = [p for _, p in items]
    length = np.array([len(p) for p in points], dtype=np.int64)
    edits = (length * EDIT_RATE).astype(np.int64)
    with np.errstate(over="ignore"):
        h = np.concatenate([gram_hashes(p, q) for p in points])
    item = np.repeat(np.arange(len(points)), length - q + 1)
    place = np.concatenate([np.arange(n - q + 1) for n in length])
    order = np.argsort(h, kind="stable")
    grams, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << FILTER_BITS, dtype=bool)
    seen[grams >> np.uint64(64 - FILTER_BITS)] = True
    return {"q": q, "ids": [i for i, _ in items], "points": points, "edits": edits, "least": length - q + 1 - q * edits, "grams": grams,
            "first": np.append(first, len(h)), "item": item[order], "place": place[order], "seen": seen}


def _shared(index: dict, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text position, item, item position) of every shared q-gram."""
    at = np.flatnonzero(index["seen"][h >> np.uint64(64 - FILTER_BITS)])
    g = np.searchsorted(index["grams"], h[at])
    g[g == len(index["grams"])] = 0
    same = index["grams"][g] == h[at] if len(index["grams"]) else np.zeros(len(at), dtype=bool)
    at, g = at[same], g[same]
    n = index["first"][g + 1] - index["first"][g]
    start = np.repeat(index["first"][g] - np.r_[0, np.cumsum(n)[:-1]], n) if len(n) else n
    rows = start + np.arange(int(n.sum()))
    return np.repeat(at, n), index["item"][rows], index["place"][rows]


def _fit(item: np.ndarray, part: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """(edits, end) of the best place of ``item`` in ``part`` whose diagonals stay in low .. high; free ends."""
    w = high - low + 1
    k = np.arange(w)
    far = np.int64(1 << 30)
    y = np.full(len(item) + w + 1, -1, dtype=np.int64)  # y[t] = part[t + low]
    a, b = max(0, low), min(len(part), low + len(y))
    if b > a:
        y[a - low:b - low] = part[a:b]
    j0 = k + low  # column of row 0
    cur = np.where((j0 >= 0) & (j0 <= len(part)), 0, far)
    for i in range(1, len(item) + 1):
        nxt = cur + (y[i - 1:i - 1 + w] != item[i - 1])
        np.minimum(nxt[:-1], cur[1:] + 1, out=nxt[:-1])
        j = k + low + i
        nxt[(j < 1) & (j != 0) | (j > len(part))] = far
        nxt[j == 0] = i
        cur = np.minimum.accumulate(nxt - k) + k
    best = int(cur.argmin())
    return int(cur[best]), best + low + len(item)


def find_passages(index: list[dict], text: str) -> list[tuple[int, int, int, int, int]]:
    """(item id, start, end, edits, shared q-grams) of every leaked passage, in characters of the text."""
    points, places = normalised(text)
    found = [h for part in index for h in _passages_of(part, points)]
    return [(i, int(places[s]), int(places[t - 1]) + 1, e, n) for i, s, t, e, n in found]


def _passages_of(index: dict, points: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    with np.errstate(over="ignore"):
        at, item, place = _shared(index, gram_hashes(points, index["q"]))
    if not len(at):
        return []
    enough = np.bincount(item, minlength=len(index["ids"])) >= index["least"]
    on = enough[item]
    at, item, place = at[on], item[on], place[on]
    diagonal = at - place + _ORIGIN
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    width = 2 * (index["edits"][item] + 1)
    for shift in (0, 1):
        band = (diagonal + shift * width // 2) // width
        key, count = np.unique((item << 40) + band, return_counts=True)
        for kk, n in zip(key.tolist(), count.tolist(), strict=True):
            i, b = kk >> 40, kk & ((1 << 40) - 1)
            if n < index["least"][i]:
                continue
            e = int(index["edits"][i])
            low = b * 2 * (e + 1) - shift * (e + 1) - _ORIGIN - e
            here = diagonal[(item == i) & (band == b)]
            usual = int(np.bincount(here - here.min()).argmax() + here.min()) - _ORIGIN
            span = _verify(index["points"][i], points, low, low + 4 * e + 1, e, usual)
            if span:
                edits, start, end = span
                old = found.get((i, start // max(1, len(index["points"][i]) // 2)))
                if old is None or edits < old[0]:
                    found[i, start // max(1, len(index["points"][i]) // 2)] = (edits, start, end, n)
    out: list[tuple[int, int, int, int, int]] = []
    for (i, _), (edits, start, end, n) in sorted(found.items(), key=lambda x: (x[0][0], x[1][0], x[1][1])):
        if any(o[0] == i and o[1] < end and start < o[2] for o in out):
            continue  # the same passage seen from a neighbouring band
        out.append((i, start, end, edits, n))
    return [(index["ids"][i], s, t, e, n) for i, s, t, e, n in out]


def _verify(item: np.ndarray, points: np.ndarray, low: int, high: int, e: int, usual: int) -> tuple[int, int, int] | None:
    if usual >= 0 and np.array_equal(points[usual:usual + len(item)], item):  # on the diagonal with most hits
        return 0, usual, usual + len(item)
    edits, end = _fit(item, points, low, high)
    if edits > e or end <= 0:
        return None
    from_end = len(points) - end  # the start: the same alignment read backwards from the end found
    back, length = _fit(item[::-1], points[:end][::-1][:len(item) + e], 0, e) if edits else (0, len(item))
    if back != edits:
        length = min(len(item), len(points) - from_end)
    return edits, max(0, end - length), end


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[Row]]:
    """The items block by block, each of about BLOCK_CHARS characters at most (or one longer item)."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, 2 * -(-total // BLOCK_CHARS) if total > BLOCK_CHARS else 1)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for b in range(blocks):
        yield items.filter(block == b).orderBy("item_id", "text").collect()


def _passages(shared):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            hits = [(d, *h) for d, t in zip(batch["doc_id"], batch["text"], strict=True) for h in find_passages(shared.value, t)]
            yield pd.DataFrame(hits, columns=[c.split()[0] for c in HITS.split(", ")]).astype({"doc_id": "Int64", "item_id": "Int64"})

    return search


def leaked_passages(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per leaked passage: document, item, place in the text, edits, shared q-grams."""
    out = None
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    for rows in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(build_index([(r["item_id"], r["text"]) for r in rows]))

        found = texts.mapInPandas(_passages(shared), HITS)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks(shared):
    def leaked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: bool(find_passages(shared.value, t)))

    return leaked


def drop_leaked(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no leaked passage, decided in place (no join, no shuffle)."""
    columns, rows = docs.columns, docs.select(packed(docs), F.col(text_col).alias("text"))
    for items in _blocks(benchmark, item_col, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(build_index([(r["item_id"], r["text"]) for r in items]))

        rows = rows.filter(~F.pandas_udf(_leaks(shared), "boolean")(F.coalesce("text", F.lit(""))))
    return unpacked(rows, columns)
