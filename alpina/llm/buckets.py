"""Candidate pairs of hash buckets, without emitting all pairs of a group.

Vertices are (``id``, ``keys``, ``sketch``, ``size``): a vertex lies in the bucket of each of its keys. The sketch
estimates similarity, so a bucket needs no texts or vectors. Pairs of a bucket that score at least ``least`` and that
``may_link`` does not rule out are candidates; they are verified by the caller on the real data.

Three rounds, each followed by merging the verified pairs into components: a maximum spanning forest of each bucket (at
most n - 1 pairs); the best candidate of every two components that still meet; then every candidate that is untried
and whose ends are still in different components. So no candidate is left out: it is tried, or its ends are one
component already. A large group of copies is one component by the last round and gives no pairs there.

Where the caller gives ``exact``, one round stands for the second and third: the candidates are tried where they meet, the likeliest
first, and only links are emitted. For many texts that share a long passage, short of being links, are all candidates of each other.

A bucket above ``BLOCK`` rows is dealt out in blocks: by a hash of vertex and key in the first round
(other buckets of the same group cut it differently, so its blocks meet there), and as all block pairs
in the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import staged
from alpina.llm.components import components

BLOCK = 1024
STEP = 1 << 16  # pairs compared at once
PAIRS = "a long, b long"
MEETING = ["key", "b1", "b2", "block", "id", "component", "size", "sketch"]
TRIED = 256  # pairs verified at once
#: scores of sketch rows, one against many or row by row: (row, rows) -> float array
Score = Callable[[np.ndarray, np.ndarray], np.ndarray]
#: False only where two rows cannot be a link: (row, size, rows, sizes) -> bool array
MayLink = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Exact:
    """How candidates are verified where they meet: ``data`` gives (``id``, ``data`` binary) of the given ids, ``prepare`` makes
    a list of objects of a column of them, ``linked`` tells which of two lists' pairs are links."""

    data: Callable[[DataFrame], DataFrame]
    prepare: Callable[[pd.Series], list]
    linked: Callable[[list, list], np.ndarray]


def shared_bytes(row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of equal bytes."""
    return (rows == row).sum(-1)


def shared_bits(row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of equal bits."""
    return 8 * rows.shape[-1] - np.bitwise_count(rows ^ row).sum(-1, dtype=np.int64)


def any_pair(row: np.ndarray, size: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rules nothing out."""
    return np.ones(np.broadcast_shapes(np.shape(size), np.shape(sizes)), dtype=bool)


def repeated_buckets(vertices: DataFrame) -> DataFrame:
    """The rows (``key``, ``id``, ``blocks``) of buckets with more than one vertex. Sketches are joined only where a step needs
    them: a vertex has as many rows as keys."""
    rows = vertices.select(F.explode("keys").alias("key"), "id")
    counts = staged(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                    .select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "bucket-counts")
    return staged(rows.join(counts, "key"), "bucket-rows")


def _forest(ids, sketches, sizes, score: Score, least: float, may_link: MayLink) -> list[tuple[int, int]]:
    """Maximum spanning forest of one bucket over its candidates."""
    n = len(ids)
    best, parent = np.full(n, -np.inf), np.full(n, -1)
    todo = np.ones(n, dtype=bool)
    out = []
    for _ in range(n):
        i = int(np.argmax(np.where(todo, best, -np.inf))) if np.isfinite(best[todo]).any() else int(np.flatnonzero(todo)[0])
        todo[i] = False
        if parent[i] >= 0:
            out.append((int(ids[parent[i]]), int(ids[i])))
        s = score(sketches[i], sketches).astype(float)
        better = np.flatnonzero(todo & (s > best) & (s >= least))
        better = better[may_link(sketches[i], sizes[i], sketches[better], sizes[better])]
        best[better], parent[better] = s[better], i
    return out


def _pairs(starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of row numbers (i < j) of the same group, about ``STEP`` at a time."""
    rows = np.arange(starts[-1])
    after = np.repeat(starts[1:], np.diff(starts)) - rows - 1
    total = np.r_[0, np.cumsum(after)]
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(total, total[at] + STEP, side="right")) - 1)
        i = np.repeat(rows[at:to], after[at:to])
        yield i, np.arange(total[at], total[to]) - total[i] + i + 1
        at = to


def _candidates(starts, sketches, sizes, score: Score, least: float, may_link: MayLink, apart=None):
    """(i, j, score) of the candidates of all groups; ``apart`` (i, j) drops pairs beforehand."""
    for i, j in _pairs(starts):
        if apart is not None:
            keep = apart(i, j)
            i, j = i[keep], j[keep]
        s = score(sketches[i], sketches[j])
        keep = s >= least
        i, j, s = i[keep], j[keep], s[keep]
        keep = may_link(sketches[i], sizes[i], sketches[j], sizes[j])
        yield i[keep], j[keep], s[keep]


def _by_group(batches: Iterator[pd.DataFrame], keys: list[str], each) -> Iterator[pd.DataFrame]:
    """Apply ``each`` to the complete groups of batches that are sorted by ``keys``."""
    rest = None
    for batch in batches:
        batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        k = batch[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)]) if len(batch) else np.zeros(0, dtype=int)
        if len(starts) < 2:
            rest = batch
            continue
        rest = batch.iloc[starts[-1]:]
        yield each(batch.iloc[:starts[-1]].reset_index(drop=True), starts)
    if rest is not None and len(rest):
        k = rest[keys].to_numpy()
        starts = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(1)])
        yield each(rest.reset_index(drop=True), np.r_[starts, len(rest)])


def _ordered(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    p = np.stack([a, b], axis=1).astype(np.int64)
    p = p[p[:, 0] != p[:, 1]]
    return pd.DataFrame(np.unique(np.sort(p, axis=1), axis=0), columns=["a", "b"])


def _sketches(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["sketch"]), dtype=np.uint8).reshape(len(frame), -1)


SMALL = 32  # rows up to which a bucket's pairs are compared together with other buckets'


def forest_pairs(rows: DataFrame, vertices: DataFrame, score: Score, least: float, may_link: MayLink) -> DataFrame:
    def each(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ids, sizes, sk = frame["id"].to_numpy(), frame["size"].to_numpy(), _sketches(frame)
        lengths = np.diff(starts)
        pairs = []
        for s, n in zip(starts[:-1][lengths > SMALL], lengths[lengths > SMALL], strict=True):
            part = slice(s, s + n)
            pairs += _forest(ids[part], sk[part], sizes[part], score, least, may_link)
        small = np.flatnonzero(np.repeat(lengths <= SMALL, lengths))
        near = np.zeros(len(frame), dtype=bool)
        for i, j, _ in _candidates(np.r_[0, np.cumsum(lengths[lengths <= SMALL])], sk[small], sizes[small], score, least, may_link):
            near[small[i]] = near[small[j]] = True
        at = np.flatnonzero(near)
        group = np.searchsorted(starts, at, side="right")
        for part in np.split(at, np.flatnonzero(group[1:] != group[:-1]) + 1) if len(at) else []:
            pairs += [tuple(ids[part])] if len(part) == 2 else _forest(ids[part], sk[part], sizes[part], score, least, may_link)
        p = np.array(pairs, dtype=np.int64).reshape(-1, 2)
        return _ordered(p[:, 0], p[:, 1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _by_group(batches, ["key", "block"], each)

    block = F.pmod(F.xxhash64("id", "key"), F.col("blocks")).cast("long")
    dealt = rows.select("key", "id", block.alias("block")).join(vertices.select("id", "sketch", "size"), "id")
    return (dealt.select("key", "block", "id", "size", "sketch").repartition("key", "block")
            .sortWithinPartitions("key", "block").mapInPandas(run, PAIRS).distinct())


def _meeting(rows: DataFrame, vertices: DataFrame, comps: DataFrame, *more: str) -> DataFrame:
    """The rows of buckets that still hold several components, dealt to the pairs of their bucket's blocks and sorted by them."""
    known = staged(rows.join(comps, "id", "left").withColumn("component", F.coalesce("component", "id")), "bucket-known")
    mixed = staged(known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .filter("lo <> hi").select("key"), "buckets-mixed")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (known.join(mixed, "key").withColumn("block", block).withColumn("other", other)
             .withColumn("b1", F.least("block", "other")).withColumn("b2", F.greatest("block", "other")))
    return (dealt.join(vertices.select("id", "sketch", "size", *more), "id").select(*MEETING, *more)
            .repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2"))


def _apart(frame: pd.DataFrame, starts: np.ndarray):
    """Whether two rows of a group are for this group to compare: different components, and of both blocks if it has two."""
    comp, block = frame["component"].to_numpy(), frame["block"].to_numpy()
    crossing = np.repeat((frame["b1"] != frame["b2"]).to_numpy()[starts[:-1]], np.diff(starts))

    def apart(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (comp[i] != comp[j]) & (~crossing[i] | (block[i] != block[j]))

    return apart


def crossing_pairs(rows: DataFrame, vertices: DataFrame, comps: DataFrame, score: Score, least: float, may_link: MayLink,
                   best: bool) -> DataFrame:
    """Candidates whose ends are in different components: all, or the ``best`` of every two components that meet."""
    def each(frame: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
        ids, comp, sizes = (frame[c].to_numpy() for c in ("id", "component", "size"))
        apart = _apart(frame, starts)
        for i, j, s in _candidates(starts, _sketches(frame), sizes, score, least, may_link, apart):
            if best and len(i):
                lo, hi = np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j])
                order = np.lexsort((-s, hi, lo))
                lo, hi = lo[order], hi[order]
                first = order[np.r_[True, (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]]
                i, j = i[first], j[first]
            yield _ordered(ids[i], ids[j])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frames in _by_group(batches, ["key", "b1", "b2"], each):
            yield from frames

    return _meeting(rows, vertices, comps).mapInPandas(run, PAIRS).distinct()


def _first_meeting(frame: pd.DataFrame):
    """Whether this bucket is the first, in the order of the tables, that two rows share; so a pair is tried in one bucket."""
    width = max(map(len, frame["keys"]), default=0)
    keys = np.repeat(-1 - np.arange(len(frame))[:, None], width, axis=1)  # what pads a short row equals no other
    for n, k in enumerate(frame["keys"]):
        keys[n, :len(k)] = k
    here = frame["key"].to_numpy()

    def first(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        table = (keys[i] == keys[j]).argmax(axis=1)
        return keys[i, table] == here[i]

    return first


def settled_links(rows: DataFrame, vertices: DataFrame, comps: DataFrame, score: Score, least: float, may_link: MayLink,
                  exact: Exact) -> DataFrame:
    """Links that join what is left apart, found where the candidates meet, so pairs are never written.

    First every group names its rows that have a candidate; then what ``exact`` compares is joined to just those
    rows, and each group tries its candidates, but for pairs that its own links have joined by then. A pair belongs to the first
    bucket it meets in (``keys`` stand table by table). At most n - 1 links come from a group of n rows."""
    def names(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        near = np.zeros(len(frame), dtype=bool)
        mine, first = _apart(frame, starts), _first_meeting(frame)
        for i, j, _ in _candidates(starts, _sketches(frame), frame["size"].to_numpy(), score, least, may_link,
                                   lambda i, j: mine(i, j) & first(i, j)):
            near[i] = near[j] = True
        return frame[near]

    def run_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _by_group(batches, ["key", "b1", "b2"], names)

    prepare, linked = exact.prepare, exact.linked  # what tasks need of it

    def tries(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ids, data = frame["id"].to_numpy(), prepare(frame["data"])
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        # components of one group: (group, component) numbered, joined as links are found
        _, local = np.unique(np.stack([group, frame["component"].to_numpy()], axis=1), axis=0, return_inverse=True)
        parent = np.arange(local.max() + 1)
        label = parent[local]
        mine, first = _apart(frame, starts), _first_meeting(frame)

        def open_(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return label[i] != label[j]

        links = []
        for i, j, s in _candidates(starts, _sketches(frame), frame["size"].to_numpy(), score, least, may_link,
                                   lambda i, j: open_(i, j) & mine(i, j) & first(i, j)):
            order = np.argsort(-s, kind="stable")
            i, j = i[order], j[order]
            while len(i):
                x, y = i[:TRIED], j[:TRIED]
                i, j = i[TRIED:], j[TRIED:]
                ok = np.flatnonzero(linked([data[k] for k in x], [data[k] for k in y]))
                for a, b in zip(x[ok], y[ok], strict=True):
                    p, q = parent[local[a]], parent[local[b]]
                    if p != q:
                        parent[parent == max(p, q)] = min(p, q)
                        links.append((ids[a], ids[b]))
                if len(ok):
                    label = parent[local]
                    rest = open_(i, j)
                    i, j = i[rest], j[rest]
        p = np.array(links, dtype=np.int64).reshape(-1, 2)
        return _ordered(p[:, 0], p[:, 1])

    def run_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _by_group(batches, ["key", "b1", "b2"], tries)

    meeting = "key long, b1 long, b2 long, block long, id long, component long, size int, sketch binary, keys array<long>"
    near = staged(_meeting(rows, vertices, comps, "keys").mapInPandas(run_names, meeting), "buckets-near")
    data = staged(exact.data(near.select("id").distinct()), "buckets-data")
    return (near.join(data, "id").select(*MEETING, "keys", "data").repartition("key", "b1", "b2").sortWithinPartitions("key", "b1", "b2")
            .mapInPandas(run_tries, PAIRS).distinct())


def linked_components(vertices: DataFrame, verify: Callable[[DataFrame], DataFrame], score: Score, least: float,
                      may_link: MayLink = any_pair, *, exact: Exact | None = None, more_links: DataFrame | None = None) -> DataFrame:
    """Components over verified candidate pairs. ``verify`` keeps the linked rows of an (a, b) table; ``exact`` does the same
    where the candidates meet, after the first round; ``more_links`` (a, b) hold beforehand."""
    rows = repeated_buckets(vertices)
    tried = staged(forest_pairs(rows, vertices, score, least, may_link), "pairs")
    links = staged(verify(tried), "links")
    if more_links is not None:
        links = links.unionByName(more_links)
    for best in (True, False):
        comps = staged(components(links), "bucket-components")
        if exact:
            return components(links.unionByName(staged(settled_links(rows, vertices, comps, score, least, may_link, exact), "links")))
        more = staged(crossing_pairs(rows, vertices, comps, score, least, may_link, best).join(tried, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            tried = tried.unionByName(more)
            links = links.unionByName(staged(verify(more), "links"))
    return components(links)
