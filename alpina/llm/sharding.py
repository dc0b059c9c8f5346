"""Sharding by extendible hashing: a directory indexed by hash-prefix bits.

A document's key is the first 60 bits of the MD5 of its id and text. The root shard has depth 0;
a shard above the byte limit splits on the next bit, the others stay whole. A document's shard is
thus the shortest prefix of its key whose documents fit the limit.

The directory is built ``STEP`` bits at a time from byte totals per prefix (pre-aggregated in the map
tasks, at most 2^STEP rows per shard that is still open), and each round looks only at documents of
open shards. Documents find their shard by an equi-join with the directory on the prefix bits.

Defined results: a null text has 0 bytes and a null id counts as empty; a document above the limit
is a shard of its own (``oversize``); repeated rows have equal keys, and if all of them together
exceed the limit at the last bit, the shard is continued on numbered overflow pages, each within the
limit; an empty table gives an empty table. Extra columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm.common import packed, staged

LIMIT_BYTES = 1 << 20
KEY_BITS = 60
STEP = 6


def shard_key(id_col: str, text_col: str) -> Column:
    text = F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                       F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def _prefix(depth) -> Column:
    d = F.lit(depth) if isinstance(depth, int) else depth
    return F.expr("0L") if isinstance(depth, int) and depth == 0 else F.call_function(
        "shiftright", F.col("key"), (F.lit(KEY_BITS) - d).cast("int"))


def _slots(open_docs: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """Directory page for the bits ``above``+1 .. ``depth``: every occupied ``depth``-bit prefix with
    its shard (``depth``, bytes, rows, largest row), or a null shard where it is still too large."""
    slots = open_docs.groupBy(_prefix(depth).alias("slot")).agg(
        F.sum("n_bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.max("n_bytes").alias("largest"))
    first = 0 if above == 0 else above + 1
    levels = F.explode(F.sequence(F.lit(first), F.lit(depth)))
    nodes = (slots.select("slot", "b", "n", "largest", levels.alias("d"))
             .withColumn("prefix", F.call_function("shiftright", "slot", F.lit(depth) - F.col("d")))
             .groupBy("d", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"),
                                         F.max("largest").alias("largest"))
             .filter((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)
                     | (F.col("d") == KEY_BITS)))
    fit = (slots.select("slot", levels.alias("d"))
           .withColumn("prefix", F.call_function("shiftright", "slot", F.lit(depth) - F.col("d")))
           .join(nodes, ["d", "prefix"])
           .groupBy("slot").agg(F.min(F.struct("d", "shard_bytes", "shard_docs", "largest")).alias("shard")))
    return slots.select("slot").join(fit, "slot", "left")


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES, *, id_col: str = "doc_id",
                  text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (default: the id) plus ``n_bytes``, ``shard`` (its bits, '-page' appended on
    overflow), ``depth``, ``shard_bytes``, ``shard_docs`` and ``oversize`` for every input row."""
    keep = [id_col] if keep is None else keep
    narrow = staged(docs.select(packed(docs.select(*keep)), shard_key(id_col, text_col).alias("key"),
                                F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes")),
                    "shard-keys")
    pages, open_docs, above = [], narrow, 0
    while True:
        depth = min(above + STEP, KEY_BITS)
        page = staged(_slots(open_docs, above, depth, limit), "shard-directory")
        pages.append((depth, page))
        still_open = page.filter("shard IS NULL").select("slot")
        if depth == KEY_BITS or still_open.isEmpty():
            break
        open_docs = open_docs.withColumn("slot", _prefix(depth)).join(still_open, "slot", "left_semi").drop("slot")
        above = depth
    placed = narrow.withColumn("found", F.lit(None).cast(pages[0][1].schema["shard"].dataType))
    for depth, page in pages:
        page = page.filter("shard IS NOT NULL").select("slot", F.col("shard").alias("here"))
        placed = (placed.withColumn("slot", _prefix(depth)).join(page, "slot", "left")
                  .withColumn("found", F.coalesce("found", "here")).drop("slot", "here"))
    bits = F.expr("lpad(bin(shiftright(key, CAST(60 - found.d AS INT))), found.d, '0')")
    placed = placed.withColumn("bits", F.when(F.col("found.d") == 0, "").otherwise(bits))
    fits = (F.col("found.shard_bytes") <= limit) | (F.col("found.shard_docs") == 1)
    whole = placed.filter(fits).select(
        "row", "n_bytes", F.col("bits").alias("shard"), F.col("found.d").alias("depth"), "found.shard_bytes",
        "found.shard_docs")
    return _finish(whole.unionByName(_overflow(placed.filter(~fits), limit)), keep, limit)


def _overflow(rows: DataFrame, limit: int) -> DataFrame:
    """Pages of rows with one key whose total exceeds the limit at the last bit."""
    per_page = F.greatest(F.floor(F.lit(limit) / F.greatest(F.col("found.largest"), F.lit(1))), F.lit(1))
    number = F.row_number().over(Window.partitionBy("key").orderBy("n_bytes")) - 1
    paged = rows.withColumn("page", F.floor(number / per_page))
    same = Window.partitionBy("key", "page")
    return paged.select("row", "n_bytes", F.concat("bits", F.lit("-"), F.col("page").cast("string")).alias("shard"),
                        F.col("found.d").alias("depth"), F.sum("n_bytes").over(same).alias("shard_bytes"),
                        F.count(F.lit(1)).over(same).alias("shard_docs"))


def _finish(df: DataFrame, keep: list[str], limit: int) -> DataFrame:
    return df.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "n_bytes", "shard",
                     F.col("depth").cast("int"), "shard_bytes", "shard_docs",
                     (F.col("shard_bytes") > limit).alias("oversize"))
