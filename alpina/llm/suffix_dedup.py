"""Exact substring deduplication: bytes covered by a LENGTH-byte string that also starts earlier.

Suffixes are sorted only where strings can repeat, and only as far as LENGTH bytes:

1. Every window of LENGTH bytes is filed under its anchor (``anchors``); runs of windows with one anchor
   are a segment. Anchors are counted (combined in the map tasks); segments whose anchor occurs once go.
2. Segments with one anchor and equal bytes (two 64-bit hashes) are a class. All but the earliest of a class
   are repeats as they stand, so a group of copies of any size costs one row per segment.
3. The earliest segments of anchors with several classes fetch their bytes, meet by anchor, and their
   windows are put in order by deep-shallow sorting (``deep_shallow``); equal ones but the earliest are repeats.
   Anchors with more than ``BLOCK`` classes are sorted in blocks, and what is earliest in its block
   meets again by its bytes.

Documents are ordered by id. A repeated window covers its bytes; covered bytes are removed.

Defined results: null and empty texts and texts below LENGTH bytes lose nothing; a null id comes after
all others; rows repeating id and text are one document; different texts with one id (or none) are separate
documents, ordered by a hash of their text; very long texts are cut into overlapping pieces for
hashing only; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm import anchors
from alpina.llm.common import staged
from alpina.llm.deep_shallow import equal_groups

LENGTH = 100
BLOCK = 4096
BUFFER = 1 << 20
SORTED_AT_ONCE = 1 << 23
LAST = (1 << 63) - 1
KEY = ["id", "tie"]
SEGMENTS = "anchor long, cover long, id long, tie long, first long, windows int"
SPANS = "id long, tie long, first long, last long"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, id, tie, text): one row per document; ``tie`` orders documents that share an id."""
    ident, text = F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(ident.alias("doc_id"), F.coalesce(ident, F.lit(LAST)).alias("id"), text.alias("text"))
    repeated = staged(rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("doc_id").isNull()).alias("none"))
                      .filter("n > 1 OR none").select("id"), "suffix-repeated")
    plain = rows.withColumn("tie", F.lit(0).cast("long"))
    if not repeated.isEmpty():
        several = rows.join(repeated, "id", "left_semi").withColumn("tie", F.xxhash64("text")).groupBy(*KEY).agg(
            F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        plain = plain.join(repeated, "id", "left_anti").select("doc_id", *KEY, "text").unionByName(several)
    return plain.select("doc_id", *KEY, "text")


def _pieces(data: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(place, bytes) of pieces that hold every window once."""
    for at in range(0, max(1, len(data) - length + 1), anchors.PIECE):
        yield at, data[at:at + anchors.PIECE + length - 1]


def _segments(length: int):
    def flush(held):
        starts = np.r_[0, np.cumsum([len(p) for *_, p in held])]
        with np.errstate(over="ignore"):
            text, first, count, anchor, cover = anchors.segments(
                np.frombuffer(b"".join(p for *_, p in held), dtype=np.uint8), starts, length)
        column = [np.array([h[i] for h in held], dtype=np.int64)[text] for i in range(3)]
        return pd.DataFrame({"anchor": anchor.view(np.int64), "cover": cover.view(np.int64), "id": column[0],
                             "tie": column[1], "first": column[2] + first, "windows": count.astype(np.int32)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for ident, tie, text in zip(batch["id"], batch["tie"], batch["text"], strict=True):
                for at, piece in _pieces(text.encode(), length):
                    if len(piece) < length:
                        continue
                    held.append((ident, tie, at, piece))
                    size += len(piece)
                    if size >= BUFFER:
                        yield flush(held)
                        held, size = [], 0
        if held:
            yield flush(held)

    return run


def _fetch(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ident, tie, text, wanted in zip(batch["id"], batch["tie"], batch["text"], batch["wanted"], strict=True):
                data = text.encode()
                for w in wanted:
                    rows.append((w["anchor"], w["block"], w["blocks"], ident, tie, w["first"],
                                 data[w["first"]:w["first"] + w["windows"] - 1 + length]))
            yield pd.DataFrame(rows, columns=["anchor", "block", "blocks", "id", "tie", "first", "bytes"])

    return run


def _repeats(frame: pd.DataFrame, length: int) -> pd.DataFrame:
    """Sort the windows of complete anchor groups: runs of repeated windows, and for anchors in several
    blocks the bytes of each window that is the earliest in its block."""
    data = b"".join(frame["bytes"])
    sizes = frame["bytes"].map(len).to_numpy()
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    count = sizes - length + 1
    row = np.repeat(np.arange(len(frame)), count)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = begin[row] + offset
    ident, tie, first = (frame[c].to_numpy(dtype=np.int64) for c in ("id", "tie", "first"))
    place = np.full(len(data), -1, dtype=np.int64)  # window of each start
    place[at] = np.arange(len(at))
    repeated = np.zeros(len(at), dtype=bool)
    starts, group = equal_groups(np.frombuffer(data, dtype=np.uint8), at, length)
    if len(starts):
        w = place[starts]
        r = row[w]
        order = np.lexsort((first[r] + offset[w], tie[r], ident[r], group))
        later = np.r_[False, group[order][1:] == group[order][:-1]]
        repeated[w[order[later]]] = True
    edge = np.flatnonzero(np.r_[True, (repeated[1:] != repeated[:-1]) | (row[1:] != row[:-1])])
    end = np.r_[edge[1:], len(at)] - 1
    runs = repeated[edge]
    a, z = edge[runs], end[runs]
    spans = pd.DataFrame({"id": ident[row[a]], "tie": tie[row[a]], "first": first[row[a]] + offset[a],
                          "last": first[row[z]] + offset[z] + length, "window": None})
    again = np.flatnonzero(~repeated & (frame["blocks"].to_numpy()[row] > 1))
    if not len(again):
        return spans
    s = first[row[again]] + offset[again]
    return pd.concat([spans, pd.DataFrame({"id": ident[row[again]], "tie": tie[row[again]], "first": s, "last": s + length,
                                           "window": [data[p:p + length] for p in at[again].tolist()]})], ignore_index=True)


def _sort(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            while len(batch):  # close the held groups at a group's start once they are large
                if size >= SORTED_AT_ONCE:
                    here, last = batch[["anchor", "block"]].to_numpy(), held[-1][["anchor", "block"]].to_numpy()[-1]
                    new = np.flatnonzero((here != last).any(axis=1))
                    cut = int(new[0]) if len(new) else len(batch)
                    if cut < len(batch):
                        held.append(batch.iloc[:cut])
                        yield _repeats(pd.concat(held, ignore_index=True), length)
                        held, size, batch = [], 0, batch.iloc[cut:]
                sizes = batch["bytes"].map(len).cumsum().to_numpy()
                take = min(len(batch), int(np.searchsorted(sizes, max(1, SORTED_AT_ONCE - size))) + 1)
                if size >= SORTED_AT_ONCE:
                    take = len(batch)
                held.append(batch.iloc[:take])
                size += int(sizes[take - 1])
                batch = batch.iloc[take:]
        held = [h for h in held if len(h)]
        if held:
            yield _repeats(pd.concat(held, ignore_index=True), length)

    return run


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, tie, first, last): byte ranges that consist of windows starting earlier elsewhere."""
    long_enough = texts.filter(F.octet_length("text") >= length).select(*KEY, "text")
    segments = long_enough.mapInPandas(_segments(length), SEGMENTS)
    several = staged(segments.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("anchor"), "suffix-anchors")
    hits = staged(segments.join(several, "anchor"), "suffix-segments")
    classes = staged(hits.groupBy("anchor", "cover", "windows").agg(F.min(F.struct(*KEY, "first")).alias("r")), "suffix-classes")
    copies = (hits.join(classes, ["anchor", "cover", "windows"])
              .filter(F.struct(*KEY, "first") != F.col("r"))
              .select(*KEY, "first", (F.col("first") + F.col("windows") - 1 + length).alias("last")))
    mixed = staged(classes.groupBy("anchor").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
                                                 F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "suffix-mixed")
    wanted = (classes.join(mixed, "anchor").select("r.*", "anchor", "windows", "blocks")
              .withColumn("block", F.pmod(F.xxhash64(*KEY, "first"), F.col("blocks")).cast("int"))
              .groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "block", "blocks", "first", "windows")).alias("wanted")))
    fetched = long_enough.join(staged(wanted, "suffix-wanted"), KEY).mapInPandas(
        _fetch(length), "anchor long, block int, blocks int, id long, tie long, first long, bytes binary")
    ordered = fetched.repartition("anchor", "block").sortWithinPartitions("anchor", "block")
    found = staged(ordered.mapInPandas(_sort(length), SPANS + ", window binary"), "suffix-sorted")
    same = Window.partitionBy("window").orderBy(*KEY, "first")
    later = found.filter("window IS NOT NULL").withColumn("rn", F.row_number().over(same)).filter("rn > 1")
    span = [*KEY, "first", "last"]
    return copies.union(found.filter("window IS NULL").select(*span)).union(later.select(*span))


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
            data = text.encode()
            runs: list[list[int]] = []
            for first, last in sorted((s["first"], s["last"]) for s in spans) if spans is not None else ():
                if runs and first <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], last)
                else:
                    runs.append([first, last])
            kept, at = [], 0
            for first, last in runs:
                kept.append(data[at:first])
                at = last
            kept = b"".join([*kept, data[at:]])
            rows.append((doc_id, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]).astype({"doc_id": "Int64"})


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (the bytes left) per document."""
    texts = _texts(docs, id_col, text_col)
    spans = staged(repeated_spans(texts, length).groupBy(*KEY).agg(F.collect_list(F.struct("first", "last")).alias("spans")), "suffix-spans")
    return (texts.join(spans, KEY, "left").select("doc_id", "text", "spans")
            .mapInPandas(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
