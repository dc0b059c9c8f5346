"""Deep-shallow sorting of byte strings that start at given places of a buffer.

Shallow: multikey quicksort over ``SHALLOW`` symbols of 8 bytes: a range is split by a pivot symbol into smaller,
equal and larger, and only the equal part goes on to the next symbol; the ranges below ``SMALL`` are
finished together, symbol by symbol, by numpy's sort. Deep: strings that still agree are ordered by a blind trie, which
stores only the places where strings branch: a string descends by those bytes alone, is compared
once with the leaf it reaches, and is added to it (equal) or branches off at their first difference.
"""

from __future__ import annotations

import numpy as np

SYMBOL = 8
SHALLOW = 4
SMALL = 1 << 15


class BlindTrie:
    """Byte strings of one length; equal ones share a leaf."""

    __slots__ = ("root", "length")

    def __init__(self, length: int):
        self.root, self.length = None, length

    def add(self, text: bytes, name: int) -> None:
        if self.root is None:
            self.root = (text, [name])
            return
        node = self.root
        while isinstance(node, list):  # [branching place, {byte: child}]
            child = node[1].get(text[node[0]])
            node = child if child is not None else next(iter(node[1].values()))
        other, names = node
        if other == text:
            names.append(name)
            return
        differ = int.from_bytes(other, "big") ^ int.from_bytes(text, "big")
        at = self.length - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while isinstance(node, list) and node[0] < at:
            parent, node = node, node[1][text[node[0]]]
        leaf = (text, [name])
        if isinstance(node, list) and node[0] == at:
            node[1][text[at]] = leaf
            return
        branch = [at, {other[at]: node, text[at]: leaf}]
        if parent is None:
            self.root = branch
        else:
            parent[1][text[parent[0]]] = branch

    def leaves(self):
        """Names of equal strings, in the strings' order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            else:
                yield node[1]


def _bytes_at(data: np.ndarray, starts: np.ndarray, at: int) -> np.ndarray:
    """The 8 bytes ``at`` bytes from each start, as big-endian numbers."""
    words = np.ndarray(len(data) - SYMBOL + 1, ">u8", data, 0, (1,))
    return words[starts + at].astype(np.uint64)


def _symbols(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    return _bytes_at(data, starts, depth * SYMBOL)


def _pivot(key: np.ndarray) -> np.uint64:
    sample = key[:: max(1, len(key) // 999)]
    return np.partition(sample, len(sample) // 2)[len(sample) // 2]


def _multikey(data: np.ndarray, starts: np.ndarray, deepest: int):
    """(starts, depth) of ranges in order, small or settled: each agrees on ``depth`` symbols."""
    stack = [(starts, 0)]
    while stack:
        part, depth = stack.pop()
        if depth == deepest or len(part) <= SMALL:
            yield part, depth
            continue
        key = _symbols(data, part, depth)
        pivot = _pivot(key)
        parts = ((part[key > pivot], depth), (part[key == pivot], depth + 1), (part[key < pivot], depth))
        stack.extend(x for x in parts if len(x[0]))


def _finish(data: np.ndarray, part: np.ndarray, depth: int, deepest: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, group) of the strings of a small range that agree with another on ``deepest`` symbols, in order."""
    group = np.zeros(len(part), dtype=np.int64)
    for d in range(depth, deepest):
        if not len(part):
            break
        key = _symbols(data, part, d)
        order = np.lexsort((key, group))
        part, key, group = part[order], key[order], group[order]
        new = np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1
        part, group = part[several], group[several]
    return part, group


def equal_groups(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, class) of the strings that equal another one, in the strings' order; one class per string."""
    deepest = min(SHALLOW, length // SYMBOL)
    done, raw = deepest * SYMBOL, data.tobytes()
    out, sizes = [], []
    for part, depth in _multikey(data, starts, deepest):
        part, group = _finish(data, part, depth, deepest)
        if len(part) < 2:
            continue
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        count = np.diff(np.r_[first, len(part)])
        pair = first[count == 2]  # a trie of two leaves is one comparison
        same = np.ones(len(pair), dtype=bool)
        for at in [*range(done, length - SYMBOL, SYMBOL), length - SYMBOL]:
            same &= _bytes_at(data, part[pair], at) == _bytes_at(data, part[pair + 1], at)
        equal = np.zeros(len(part), dtype=bool)
        equal[pair] = same
        for s, n in zip(first.tolist(), count.tolist(), strict=True):
            if n == 2:
                if equal[s]:
                    out += [int(part[s]), int(part[s + 1])]
                    sizes.append(2)
                continue
            trie = BlindTrie(length - done)
            for p in part[s:s + n].tolist():
                trie.add(raw[p + done:p + length], p)
            for names in trie.leaves():
                if len(names) > 1:
                    out += names
                    sizes.append(len(names))
    return np.array(out, dtype=np.int64), np.repeat(np.arange(len(sizes)), sizes)
