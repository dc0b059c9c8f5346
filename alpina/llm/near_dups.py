"""Near-duplicate documents: Order MinHash with banded alignment.

A document's k-mers are runs of ``K`` = 2 words (lower-cased letters and digits), labelled with their
occurrence. For each of ``TABLES`` hash functions the ``SAMPLE`` smallest labelled k-mers are taken and put
back into text order; their sequence is the bucket key, so it reacts to edits and to moved text. One
byte of every minimum forms a sketch that estimates similarity inside buckets. Word counts in ``BINS`` bins follow it:
an edit takes one word out of a bin and puts one into another at most, so pairs whose counts differ by more than the
allowed edits cannot link and need no alignment.

``K``, ``SAMPLE`` and ``TABLES`` follow from the link's limit: at 20 % scattered word edits 0.64 of the 2-word k-mers
are left, a Jaccard similarity of 0.47, so two texts share a table's key with 0.22 and miss all 32 tables in about 1
of 3,000 cases (texts of 5 words, with 4 k-mers, in about 1 of 14).

Candidate pairs (``buckets``) are verified by banded alignment of the whole word sequences: two documents
are linked if 1 - edits / longer length >= 0.8. Copies of one text (same SHA-256) are one class and
compared once. Groups are the connected components of links and copies.

Defined results: null counts as empty; texts without words are grouped only with equal texts; rows that
share an id share their group, so the texts of one id and all that link to them are one group; rows without an id are grouped by their
text and named by a negative id; very long texts are compared whole; an empty table gives an empty table. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.llm import buckets
from alpina.llm.alignment import edit_distances
from alpina.llm.common import packed, settled, staged, unpacked
from alpina.llm.words import mix, shingle_hashes, word_hashes

K = 2
SIMILARITY = 0.8
TABLES = 32
SAMPLE = 2
SHARED_MINIMA = 3  # of TABLES; a pair at the limit shares 15 on average, so this is 4 standard deviations
BROADCAST_IDS = 1_000_000  # of 8 bytes
BINS = 128  # of the word counts that follow the minima in a sketch
_SEEDS = mix(np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_TAKEN = np.uint64((1 << 64) - 1)


def occurrences(h: np.ndarray) -> np.ndarray:
    """How often each value stands before its place."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    at = np.arange(len(s))
    first = np.maximum.accumulate(np.where(np.r_[True, s[1:] != s[:-1]], at, 0))
    out = np.empty(len(h), dtype=np.uint64)
    out[order] = at - first
    return out


def order_minhash(words: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Bucket keys (one per table) and the sketch of a word sequence that isn't empty."""
    grams = shingle_hashes(words, K)
    labelled = mix(grams + occurrences(grams) * np.uint64(0xC2B2AE3D27D4EB4F))
    take = min(SAMPLE, len(grams))
    h = labelled ^ _SEEDS[:, None]
    h *= (_SEEDS | np.uint64(1))[:, None]
    minima, at, each = h.min(axis=1), np.empty((TABLES, take), dtype=np.int64), np.arange(TABLES)
    for i in range(take):
        at[:, i] = h.argmin(axis=1)
        h[each, at[:, i]] = _TAKEN
    chosen = grams[np.sort(at, axis=1)]
    keys = np.arange(1, TABLES + 1, dtype=np.uint64)
    for i in range(take):
        keys = mix(keys * np.uint64(0x9FB21C651E98DF25) + chosen[:, i])
    return keys, (mix(minima) & np.uint64(255)).astype(np.uint8).tobytes()


def word_bins(words: np.ndarray) -> bytes:
    counts = np.bincount((mix(words) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def shared_minima(row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return buckets.shared_bytes(row[..., :TABLES], rows[..., :TABLES])


def edit_limits(longest: np.ndarray) -> np.ndarray:
    """The most edits that two texts may differ by."""
    return np.floor(longest * (1 - SIMILARITY) + 1e-9).astype(np.int64)


def may_link(row: np.ndarray, size: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the sketches allow few enough edits; never false for a link."""
    limits = edit_limits(np.maximum(size, sizes))
    diff = rows[..., TABLES:].astype(np.int16) - row[..., TABLES:]
    more = np.maximum(diff, 0).sum(-1, dtype=np.int64)
    less = more - diff.sum(-1, dtype=np.int64)
    return (np.abs(size - sizes) <= limits) & (np.maximum(more, less) <= limits)


def _sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        with np.errstate(over="ignore"):
            for ident, fp, text in zip(batch["id"], batch["fp"], batch["text"], strict=True):
                words = word_hashes(text)
                keys, sketch = order_minhash(words) if len(words) else (np.zeros(0, dtype=np.uint64), b"")
                rows.append((ident, fp, len(words), keys.view(np.int64), sketch + word_bins(words)))
        yield pd.DataFrame(rows, columns=["id", "fp", "size", "keys", "sketch"])


class Words:
    """A text's words, and the same sorted with their occurrence, so equal ones count once each."""

    def __init__(self, words: np.ndarray):
        self.words = words.view(np.int64)
        self.bag = np.sort(mix(words + occurrences(words) * np.uint64(0xC2B2AE3D27D4EB4F)))

    def shared(self, other: Words) -> int:
        """Words in common, repeats included."""
        at = np.searchsorted(other.bag, self.bag)
        at[at == len(other.bag)] = 0
        return int((other.bag[at] == self.bag).sum()) if len(other.bag) else 0


def linked(a: list[Words], b: list[Words]) -> np.ndarray:
    """Which pairs are links: an edit can bring one word of the longer text at most, so pairs that share fewer than all but
    the allowed edits are none; the others are aligned."""
    longest = np.array([max(len(x.words), len(y.words)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    limits = edit_limits(longest)
    out = np.zeros(len(a), dtype=bool)
    with np.errstate(over="ignore"):
        may = np.array([n - x.shared(y) <= e for x, y, n, e in zip(a, b, longest, limits, strict=True)], dtype=bool)
    at = np.flatnonzero(may)
    if len(at):
        out[at] = edit_distances([a[i].words for i in at], [b[i].words for i in at], limits[at]) <= limits[at]
    return out


def _aligned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache: dict[int, Words] = {}

    def words(ident: int, text: str) -> Words:
        if ident not in cache:
            if len(cache) > 256:
                cache.clear()
            cache[ident] = Words(word_hashes(text))
        return cache[ident]

    for batch in batches:
        with np.errstate(over="ignore"):
            a = [words(i, t) for i, t in zip(batch["a"], batch["ta"], strict=True)]
            b = [words(i, t) for i, t in zip(batch["b"], batch["tb"], strict=True)]
        yield batch.loc[linked(a, b), ["a", "b"]]


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        with np.errstate(over="ignore"):
            data = [word_hashes(t).tobytes() for t in batch["text"]]
        yield pd.DataFrame({"id": batch["id"], "data": data})


def _prepared(data: pd.Series) -> list[Words]:
    cache: dict[bytes, Words] = {}  # a text stands in several groups
    with np.errstate(over="ignore"):
        return [cache.get(d) or cache.setdefault(d, Words(np.frombuffer(d, dtype=np.uint64))) for d in data]


def _ident(id_col: str, text: Column) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), -F.pmod(F.xxhash64(text), F.lit((1 << 62) - 1)) - 1)


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(_ident(id_col, text).alias("doc"), text.alias("text")).withColumn("fp", F.sha2("text", 256))
    sketched = staged(keyed.select(F.col("doc").alias("id"), "fp", "text")
                      .mapInPandas(_sketch, "id long, fp string, size int, keys array<long>, sketch binary"), "omh")
    # an id may stand for several texts, so a class has a number of its own, given once, as it is written
    classes = staged(sketched.groupBy("fp").agg(F.min(F.struct("id", "size", "keys", "sketch")).alias("r"))
                     .select("fp", F.col("r.id").alias("doc"), "r.size", "r.keys", "r.sketch", F.monotonically_increasing_id().alias("id")),
                     "omh-classes")

    def texts(ids: DataFrame) -> DataFrame:
        wanted = staged(classes.select("id", "fp", "doc").join(ids, "id", "left_semi"), "omh-wanted")
        rows = keyed
        if wanted.count() <= BROADCAST_IDS:  # then only texts that are looked for are shuffled; beyond it, all are
            rows = rows.join(F.broadcast(wanted.select("doc").distinct()), "doc", "left_semi")
        return rows.join(wanted, ["doc", "fp"]).dropDuplicates(["id"]).select("id", "text")

    def verify(pairs: DataFrame) -> DataFrame:
        both = staged(texts(staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "omh-ids")), "omh-texts")
        joined = (pairs.join(both.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
                  .join(both.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a"))
        return joined.select("a", "ta", "b", "tb").mapInPandas(_aligned, buckets.PAIRS)

    # texts of one id are one group
    owned = sketched.select("id", "fp").distinct().join(classes.select("fp", F.col("id").alias("b")), "fp")
    several = staged(owned.groupBy("id").agg(F.min("b").alias("a"), F.max("b").alias("z")).filter("a <> z").select("id", "a"), "omh-several")
    same_id = staged(owned.join(several, "id").filter("a <> b").select("a", "b"), "omh-same-id")
    vertices = classes.filter("size > 0").select("id", "keys", "sketch", "size")
    exact = buckets.Exact(lambda ids: texts(ids).mapInPandas(_hashed, "id long, data binary"), _prepared, linked)
    comps = settled(docs.sparkSession, "omh-components", lambda: buckets.linked_components(
        vertices, verify, shared_minima, SHARED_MINIMA, may_link, exact=exact, more_links=same_id))
    named = classes.select("fp", "doc", "id").join(comps, "id", "left").withColumn("component", F.coalesce("component", "id"))
    heads = staged(named.groupBy("component").agg(F.min("doc").alias("group_id")), "omh-heads")
    placed = staged(named.join(heads, "component").select("fp", F.col("doc").alias("class_id"), "group_id"), "omh-placed")
    return (sketched.select("id", "fp").join(placed, "fp").groupBy("id")
            .agg(F.min("class_id").alias("class_id"), F.min("group_id").alias("group_id")))


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id``, ``class_id``, ``group_id``) per distinct id: smallest ids of its equal texts and of its group."""
    return settled(docs.sparkSession, "omh-groups", lambda: _groups(docs, id_col, text_col))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``class_id``, ``group_id`` and ``kept`` (names its group) per document."""
    groups = near_groups(docs, id_col=id_col, text_col=text_col)
    return groups.select(F.col("id").alias(id_col), "class_id", "group_id", (F.col("id") == F.col("group_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: that of the smallest id; of rows that repeat this id, the one whose
    JSON text has the least SHA-256."""
    gone = near_groups(docs, id_col=id_col, text_col=text_col).filter("id <> group_id").select("id")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(packed(docs), _ident(id_col, text).alias("id"))
    repeated = staged(rows.groupBy("id").count().filter("count > 1").select("id"), "omh-repeated")
    stays = rows.join(gone, "id", "left_anti")
    single = stays.join(repeated, "id", "left_anti")
    several = (stays.join(repeated, "id", "left_semi").groupBy("id")
               .agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row")).select("id", "row"))
    return unpacked(single.unionByName(several), docs.columns)
