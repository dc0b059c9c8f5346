"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

A vector is normalised, padded to a power of two and rotated by three rounds of random signs and
Hadamard transforms; its hash is the axis (with sign) it lies nearest to. ``HASHES`` hashes make a key and
each of ``TABLES`` tables probes the ``PROBES`` likeliest keys of a vector, best runners-up first
(at cosine 0.95 in 64 dimensions a pair misses all tables in about 1 of 10,000 cases). Candidate
pairs are screened by sign bits of the same rotations and verified by cosine in double precision.

Equal vectors are one class, compared once and weighted by its rows. Links per vector are then
counted inside each component by blocked matrix products, which emit counts, never pairs.

Defined results: a vector that is null, empty, zero or holds null or non-finite components links with
nothing; vectors of different lengths never link; rows repeating a vec_id count once (the smallest
embedding stands); rows without vec_id are returned unlinked and kept; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.llm import buckets
from alpina.llm.common import settled, staged

COSINE = 0.95
TABLES = 4
HASHES = 3
PROBES = 8
RUNNERS_UP = 4
SIGN_BYTES = 16
SAME_SIGNS = 100  # of 128; a pair at cosine 0.95 shares 115 on average, 3.4 standard deviation
SEED = 20240


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, scaled to keep lengths."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def _rotations(x: np.ndarray) -> Iterator[np.ndarray]:
    rng = np.random.default_rng([SEED, x.shape[1]])
    while True:
        y = x
        for signs in rng.choice([-1.0, 1.0], size=(3, x.shape[1])):
            y = hadamard(y * signs)
        yield y


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def hash_vectors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (rows x TABLES * PROBES) and sign bits (rows x SIGN_BYTES) of unit vectors of one length."""
    n, d = x.shape
    wide = np.zeros((n, max(8, 1 << (d - 1).bit_length())))
    wide[:, :d] = x
    turn, signs, keys = _rotations(wide), [], []
    top = min(RUNNERS_UP, wide.shape[1])
    combos = np.array(list(product(range(top), repeat=HASHES)))
    for t in range(TABLES):
        loss, code = np.zeros((n, len(combos))), np.zeros((n, len(combos)), dtype=np.uint64)
        for k in range(HASHES):
            y = next(turn)
            signs.append(y > 0)
            size = np.abs(y)
            axis = np.argsort(-size, axis=1, kind="stable")[:, :top]
            near = np.take_along_axis(size, axis, 1) ** 2
            vertex = (2 * axis + (np.take_along_axis(y, axis, 1) < 0)).astype(np.uint64)
            loss += (near[:, :1] - near)[:, combos[:, k]]
            code = code * np.uint64(2 * wide.shape[1] + 1) + vertex[:, combos[:, k]]
        first = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        mixed = (np.take_along_axis(code, first, 1) * np.uint64(TABLES) + np.uint64(t)) * np.uint64(0x9E3779B97F4A7C15)
        keys.append((mixed ^ np.uint64(d)).view(np.int64))
    while sum(s.shape[1] for s in signs) < 8 * SIGN_BYTES:
        signs.append(next(turn) > 0)
    return np.concatenate(keys, axis=1), np.packbits(np.concatenate(signs, axis=1)[:, :8 * SIGN_BYTES], axis=1)


def _by_length(frame: pd.DataFrame, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, vectors) for each vector length of a batch."""
    lengths = frame[column].map(len).to_numpy()
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, np.array([np.asarray(v, dtype=float) for v in frame[column].iloc[at]]).reshape(len(at), d)


def _hash_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at, x in _by_length(batch, "vector"):
            keys, signs = hash_vectors(unit_rows(x))
            yield pd.DataFrame({"id": batch["id"].to_numpy()[at], "keys": list(keys),
                                "sketch": [s.tobytes() for s in signs]})


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        keep = np.zeros(len(batch), dtype=bool)
        same = batch["va"].map(len).to_numpy() == batch["vb"].map(len).to_numpy()
        part = batch[same]
        for at, x in _by_length(part, "va"):
            y = np.array([np.asarray(v, dtype=float) for v in part["vb"].iloc[at]])
            keep[np.flatnonzero(same)[at]] = (unit_rows(x) * unit_rows(y)).sum(1) >= COSINE
        yield batch.loc[keep, ["a", "b"]]


def _valid() -> F.Column:
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col("embedding").isNotNull() & ~odd & F.exists("embedding", lambda x: x != 0)


def _count_links(members: DataFrame) -> DataFrame:
    """Links of every class inside its component; a block pair is one group of at most two blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / buckets.BLOCK).cast("int").alias("blocks"))
    placed = members.join(staged(sizes, "component-sizes"), "component")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = (placed.withColumn("block", block).withColumn("other", other)
             .withColumn("b1", F.least("block", "other")).withColumn("b2", F.greatest("block", "other")))

    def each(frame: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
        ids, weight, block = (frame[c].to_numpy() for c in ("id", "weight", "block"))
        links = np.zeros(len(frame), dtype=np.int64)
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            part = frame.iloc[s:e]
            for at, x in _by_length(part, "vector"):
                u, rows = unit_rows(x), s + at
                near = u @ u.T >= COSINE
                np.fill_diagonal(near, False)
                if block[s:e].min() != block[s:e].max():
                    near &= block[rows][:, None] != block[rows][None, :]
                links[rows] = near @ weight[rows]
        return pd.DataFrame({"id": ids, "links": links})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from buckets._by_group(batches, ["component", "b1", "b2"], each)

    counted = (dealt.select("component", "b1", "b2", "block", "id", "weight", "vector")
               .repartition("component", "b1", "b2").sortWithinPartitions("component", "b1", "b2")
               .mapInPandas(run, "id long, links long"))
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(embeddings: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` (names its component) per vector."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"))
    unnamed = rows.filter("vec_id IS NULL")
    rows = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    valid = F.coalesce(_valid(), F.lit(False))
    rows = staged(rows.withColumn("valid", valid), "vectors")
    good = rows.filter("valid").withColumn("fp", F.sha2(F.concat_ws(",", F.transform("embedding", lambda x: (x + F.lit(0.0)).cast("string"))), 256))
    classes = staged(good.groupBy("fp").agg(F.min(F.struct("vec_id", "embedding")).alias("first"), F.count(F.lit(1)).alias("weight"))
                     .select("fp", F.col("first.vec_id").alias("id"), F.col("first.embedding").alias("vector"), "weight"),
                     "vector-classes")
    hashed = staged(classes.select("id", "vector").mapInPandas(_hash_batches, "id long, keys array<long>, sketch binary"),
                    "vector-keys")
    vectors = classes.select("id", "vector")

    def verify(pairs: DataFrame) -> DataFrame:
        first = vectors.select(F.col("id").alias("a"), F.col("vector").alias("va"))
        second = vectors.select(F.col("id").alias("b"), F.col("vector").alias("vb"))
        return pairs.join(second, "b").join(first, "a").mapInPandas(_linked, buckets.PAIRS)

    vertices = hashed.select("id", F.array_distinct("keys").alias("keys"), "sketch", F.lit(1).alias("size"))
    comps = settled(embeddings.sparkSession, "vector-components",
                    lambda: buckets.linked_components(vertices, verify, buckets.shared_bits, SAME_SIGNS))
    links = _count_links(comps.join(classes.select("id", "vector", "weight"), "id"))
    per_class = (classes.select("fp", "id", "weight").join(comps, "id", "left").join(links, "id", "left")
                 .select("fp", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "id").alias("component_id")))
    named = good.select("vec_id", "fp").join(staged(per_class, "vector-links"), "fp").select("vec_id", "n_links", "component_id")
    alone = rows.filter("NOT valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    none = unnamed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(alone).unionByName(none).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
