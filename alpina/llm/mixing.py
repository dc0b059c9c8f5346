"""Mixing sources to target weights: systematic sampling, DataFrame functions only.

Every source gets a target share of all words. A document's expected number of copies is
``target / source size`` (at most ``MAX_COPIES``), the same for all documents of a source, so the
prefix sum of expected copies at the r-th document is ``r`` times that. One offset per source is
added, and the document is emitted once for every integer between its two prefix sums.

Documents are ranked by size first. Then the words taken follow the target within the size of about
one document, because every stretch of similar sizes is sampled at the same rate.

The rank is built level by level (size ranges, sizes, hash bins, rows of a bin), each from counts of
the level below that are aggregated before they are shuffled. No window holds the rows of a whole source.

Defined results: a null or blank text has size 0 and is never emitted; a null source is a source of
its own, ordered last; a null id ranks like the text 'null'; rows that repeat an id are separate
documents; an empty table gives an empty table. Extra columns pass through whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm.common import packed, staged, unpacked

MAX_COPIES = 3
WEIGHT_CYCLE = 3  # sources in code-point order weigh 1, 2, 3, 1, 2, 3, ...
SIZE_RANGE = 64
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets from one row per source (``has``, ``src``, ``source_size``).

    Sources share the total by weight, none above MAX_COPIES times its size: sorted by the level at
    which a source is full, the first ones are full, and the rest share what is left by weight."""
    everything = Window.partitionBy()
    named = Window.orderBy(F.col("has").desc(), "src")
    by_level = Window.orderBy("full_at", F.col("has").desc(), "src")
    t = (sizes.withColumn("weight", ((F.row_number().over(named) - 1) % WEIGHT_CYCLE + 1).cast("long"))
         .withColumn("cap", F.col("source_size") * MAX_COPIES)
         .withColumn("full_at", F.col("cap").cast("double") / F.col("weight"))
         .withColumn("left", F.sum("source_size").over(everything)
                     - F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap"))
         .withColumn("weights_left", F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", F.col("left").cast("double") / F.col("weights_left"))
         .withColumn("full", F.col("level") > F.col("full_at"))
         .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everything)))
    return t.select("has", "src", "source_size",
                    F.when(F.col("full"), F.col("cap").cast("double"))
                    .otherwise(F.col("weight") * F.col("level")).alias("target"))


def _before(df: DataFrame, within: list[str], order: str, value: str, out: str) -> DataFrame:
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(w), F.lit(0)))


def _keyed(df: DataFrame, size: Column, id_col: str, source_col: str) -> DataFrame:
    ident = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    return df.select(packed(df), size.alias("size"), F.col(source_col).isNotNull().alias("has"),
                     F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
                     ident.alias("h"), F.substring(ident, 1, 3).alias("bin"))


def mix_plan(docs: DataFrame, size: Column, *, id_col: str = "doc_id",
             source_col: str = "source", seed: str = SEED) -> DataFrame:
    """One row per input row: ``row`` (all input columns), ``size``, ``source_size``, ``target``, ``copies``."""
    keyed = _keyed(docs, size, id_col, source_col)
    # counts per source, size and hash bin: pre-aggregated in the map tasks, written once
    bins = staged(keyed.groupBy("has", "src", "size", "bin").agg(F.count(F.lit(1)).alias("n")), "mix-bins")
    src = ["has", "src"]
    sizes = bins.groupBy(*src).agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = staged(source_targets(sizes), "mix-targets")

    live = bins.filter("size > 0").withColumn("range", F.floor(F.col("size") / SIZE_RANGE))
    per_size = live.groupBy(*src, "range", "size").agg(F.sum("n").alias("n"))
    per_range = per_size.groupBy(*src, "range").agg(F.sum("n").alias("n"))
    r = _before(per_range, src, "range", "n", "r0").drop("n")
    s = _before(per_size, [*src, "range"], "size", "n", "s0").drop("n")
    b = _before(live, [*src, "range", "size"], "bin", "n", "b0").drop("n")
    start = staged(
        b.join(s, [*src, "range", "size"]).join(r, [*src, "range"]).join(targets, src)
        .select(*src, "size", "bin", (F.col("r0") + F.col("s0") + F.col("b0")).alias("rank0"),
                "source_size", "target"), "mix-starts")

    cell = Window.partitionBy(*src, "size", "bin").orderBy("h")
    rank = F.col("rank0") + F.row_number().over(cell)
    rate = F.col("target") / F.col("source_size")
    name = F.concat(F.lit(seed + ":"), F.when(F.col("has"), F.concat(F.lit("s:"), F.col("src"))).otherwise("n"))
    offset = F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    crossed = F.floor(offset + rate * rank) - F.floor(offset + rate * (rank - 1))
    placed = keyed.filter("size > 0").join(start, [*src, "size", "bin"])
    taken = placed.select("row", "size", "source_size", "target",
                          F.least(crossed, F.lit(MAX_COPIES)).cast("long").alias("copies"))
    empty = keyed.filter("size = 0").join(targets, src)
    return taken.unionByName(empty.select("row", "size", "source_size", "target",
                                          F.lit(0).cast("long").alias("copies")))


def mix_sources(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed corpus: each input row as often as it is drawn (0 to MAX_COPIES times)."""
    plan = mix_plan(docs, word_count(text_col), id_col=id_col, source_col=source_col, seed=seed)
    drawn = plan.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return unpacked(drawn, docs.columns)
