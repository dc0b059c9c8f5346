"""Ranked lexical search by NRA: impact-sorted lists read in sequence, score intervals per document.

Terms are the maximal runs of ASCII letters (lower-cased), digits and characters beyond ASCII. The impact of a term in a
document is ``w * ((10^9 tf) div (1000 tf + 12 m))``; an item's score adds the impacts of its terms, repeats included.

1. One pass over the documents keeps, per document, its number of terms and those of the items' terms it holds
   (a broadcast table of one block of items). N, L and the document frequencies are aggregates of what it wrote.
2. Every task cuts its documents into shards, sorts a shard's postings by term and falling impact, and answers each item
   by NRA (``by_intervals``): the item's lists are read to equal, doubling depths. A document's lower bound is what was read of it; its
   upper bound adds the next unread impact of every list it was not yet seen in. Reading goes on until no unseen document can
   enter, and every document that can still be among the best has equal bounds: membership, ties and scores are exact.
   Later shards of a task start from the limit that earlier ones reached.
3. The best of each task are merged per item, over salted groups first.

Nothing of the documents is shuffled but the best of each task. Items come in blocks of about ``BLOCK_TERMS`` distinct terms (or one
longer item); the documents are read once per block, so neither driver nor broadcast grows with the items.

Defined results: a null or empty text has no terms and does not count in N; rows that repeat a doc_id are documents of
their own; a null doc_id comes after all others at equal scores; very long texts count whole. Equal rows of
items are one item; one item_id with several texts gives a ranking of each text. Items without terms, and empty tables, give no rows. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm.common import staged

BEST = 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 200_000
SHARD_DOCS = 1 << 14
SHARD_POSTINGS = 1 << 22
FIRST_DEPTH = 256
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LAST = np.iinfo(np.int64).max
FORWARD = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
FOUND = pa.schema([("item", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
_SQL = {pa.int32(): "int", pa.int64(): "long", pa.list_(pa.int32()): "array<int>", pa.list_(pa.int64()): "array<long>"}


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema)


def terms_of(text: str) -> list[bytes]:
    """The terms of a text in order, as UTF-8 (all bytes beyond ASCII belong to a term)."""
    return text.encode().translate(_BYTES).split()


def item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(``item_id``, ``fp``, ``term``, ``times``) of every distinct item; ``fp`` tells texts of one id apart."""
    text = F.translate(F.col(text_col), UPPER, LOWER)
    return (items.select(F.col(item_col).cast("long").alias("item_id"), F.sha2(F.col(text_col), 256).alias("fp"), text.alias("text"))
            .distinct().select("item_id", "fp", F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).alias("term"))
            .groupBy("item_id", "fp", "term").agg(F.count(F.lit(1)).alias("times")))


def _item_blocks(table: DataFrame) -> Iterator[list]:
    """The items' terms, block by block; a block holds whole items."""
    total = table.count()
    blocks = max(1, -(-total // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id", "fp"), F.lit(blocks))
    for b in range(blocks):
        rows = table.filter(block == b).orderBy(F.col("item_id").asc_nulls_last(), "fp", "term").collect()
        if rows:
            yield rows


def _forward(vocabulary):
    """Per document its number of terms and its (term number, times) pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            ids, sizes, ends, terms, tfs = [], [], [0], [], []
            for ident, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = text.translate(_BYTES).split()
                if not words:
                    continue
                held = Counter(map(number, words))
                held.pop(None, None)
                ids.append(ident)
                sizes.append(len(words))
                terms += held.keys()
                tfs += held.values()
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], schema=FORWARD)

    return run


def lengths_factor(n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """m of documents with ``n`` terms: 100 - 25 + ((25 n N) div L)."""
    if len(n) and 25 * docs * int(n.max()) > _LAST:
        return np.array([75 + 25 * int(x) * docs // terms for x in n], dtype=np.int64)
    return 75 + 25 * n * docs // terms


class _Shard:
    """Postings of some documents: for every term its documents and impacts, by falling impact."""

    def __init__(self, ids, n, ends, terms, tfs, weights: np.ndarray, docs: int, all_terms: int):
        self.ids = ids
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        factor = lengths_factor(n, docs, all_terms)[doc]
        impact = weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * factor))
        order = np.lexsort((-impact, terms))
        self.doc, self.impact = doc[order], impact[order]
        self.start = np.searchsorted(terms[order], np.arange(len(weights) + 1))

    def lists(self, item: tuple[np.ndarray, np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for term, times in zip(*item, strict=True):
            part = slice(self.start[term], self.start[term + 1])
            if part.start < part.stop and self.impact[part.start] > 0:
                out.append((self.doc[part], self.impact[part] * times))
        return out


def by_intervals(lists: list[tuple[np.ndarray, np.ndarray]], n_docs: int, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, exact scores) of all that may be among the ``k`` best and score at least ``floor`` (1 or more).

    ``lists`` are (documents, scores) by falling score; a document stands in a list once at most."""
    low = np.zeros(n_docs, dtype=np.int64)
    at, to = 0, FIRST_DEPTH
    while True:
        for docs, scores in lists:
            low[docs[at:to]] += scores[at:to]
        ahead = [int(s[to]) if to < len(s) else 0 for _, s in lists]
        unseen = sum(ahead)
        kth = max(floor, int(np.partition(low, n_docs - k)[n_docs - k]) if n_docs > k else 0)
        if unseen < kth:  # no document that was in no list so far can enter
            seen = np.zeros(n_docs, dtype=np.int64)  # what is ahead in lists that a document was already read in
            for (docs, _), a in zip(lists, ahead, strict=True):
                if a:
                    seen[docs[:to]] += a
            may = np.flatnonzero(low + (unseen - seen) >= kth)
            if (seen[may] == unseen).all():
                return may, low[may]
        at, to = to, 2 * to


def _best(shared):
    """The ``k`` best documents of every item over all documents of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, names, weights, docs, all_terms, k = shared.value
        best = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))] * len(items)
        parts: list[tuple] = []

        def settle() -> None:
            ids, n, terms, tfs, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            shard = _Shard(ids, n, np.r_[0, np.cumsum(counts)], terms, tfs, weights, docs, all_terms)
            for i, item in enumerate(items):
                lists = shard.lists(item)
                if not lists:
                    continue
                old_ids, old = best[i]
                found, scores = by_intervals(lists, len(n), k, int(old[-1]) if len(old) == k else 1)
                new_ids, new = np.r_[old_ids, ids[found]], np.r_[old, scores]
                order = np.lexsort((new_ids, -new))[:k]
                best[i] = new_ids[order], new[order]
            parts.clear()

        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                rows = batch.slice(start, 1024)
                lists = rows.column(2)
                parts.append((rows.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False), rows.column(1).to_numpy(zero_copy_only=False),
                              lists.flatten().to_numpy(zero_copy_only=False), rows.column(3).flatten().to_numpy(zero_copy_only=False),
                              lists.value_lengths().to_numpy(zero_copy_only=False)))
                if sum(len(p[0]) for p in parts) >= SHARD_DOCS or sum(len(p[2]) for p in parts) >= SHARD_POSTINGS:
                    settle()
        if parts:
            settle()
        item = np.repeat(np.arange(len(items)), [len(b[0]) for b in best])
        ids = np.concatenate([b[0] for b in best])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array([names[i] for i in item], pa.int64()), pa.array(ids, pa.int64(), mask=ids == _LAST),
             pa.array(np.concatenate([b[1] for b in best]), pa.int64())], schema=FOUND)

    return run


def _search_block(texts: DataFrame, rows: list, k: int) -> DataFrame:
    spark = texts.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({r["term"] for r in rows}))}
    shared = spark.sparkContext.broadcast({t.encode(): i for t, i in vocabulary.items()})
    forward = staged(texts.mapInArrow(_forward(shared), _ddl(FORWARD)), "search-forward")
    shared.unpersist()
    docs, all_terms = forward.agg(F.count(F.lit(1)), F.sum("n")).first()
    # one row per term of the block at most
    held = F.lit(2.0 * docs + 2) / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.ln(held)).cast("long")
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for r in (forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
              .select("term", weight.alias("w")).collect()):
        weights[r["term"]] = r["w"]

    items: dict[tuple, list[tuple[int, int]]] = {}
    for r in rows:
        items.setdefault((r["item_id"], r["fp"]), []).append((vocabulary[r["term"]], r["times"]))
    pairs = [tuple(np.array(x, dtype=np.int64) for x in zip(*v, strict=True)) for v in items.values()]
    shared = spark.sparkContext.broadcast((pairs, [i for i, _ in items], weights, docs, all_terms, k))
    found = staged(forward.mapInArrow(_best(shared), _ddl(FOUND)).withColumn("salt", F.spark_partition_id() % SALTS), "search-found")
    shared.unpersist()
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= k)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, *, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(``item_id``, ``rank``, ``doc_id``, ``score``): the ``k`` documents that score highest for every item, above 0."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    table = staged(item_terms(items, item_col, item_text), "search-items")
    out = None
    for rows in _item_blocks(table):
        found = _search_block(texts, rows, k)
        out = found if out is None else out.unionByName(found)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
