"""Aggregate views that are refreshed from new and changed files only.

A view keeps one partial aggregate per (file, group). A refresh reads the files that are new or newer than the view
knows, aggregates them and replaces their partials (:func:`alpina.sinks.tables.replace_by_key`); files that left the
listing lose theirs. Reading merges the partials, so minimum, maximum and distinct counts are right after a
file was rewritten or removed too. What a file's partials were made from (its modification time) is stored in the same
batch as the partials: a refresh that dies leaves the view as it was.

Measures: ``{"name": ("count", None)}`` or ``(function, expression)`` with ``sum``, ``min``, ``max``, ``avg``, ``count``
(non-null values) or ``approx_distinct`` (a sketch, merged). Groups may be null; a file without rows counts as read;
the same listing again reads nothing and writes nothing. Group and measure names must not start with ``_``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.session import path_exists
from alpina.sinks.tables import read_replaced, replace_by_key

FILE, MODIFIED = "_file", "_modified"
PARTIAL = {
    "count": lambda x: {"n": F.count(F.lit(1) if x is None else x)},
    "sum": lambda x: {"s": F.sum(x)},
    "min": lambda x: {"v": F.min(x)},
    "max": lambda x: {"v": F.max(x)},
    "avg": lambda x: {"s": F.sum(x), "n": F.count(x)},
    "approx_distinct": lambda x: {"h": F.hll_sketch_agg(F.when(x.isNotNull(), F.xxhash64(x)))},
}
MERGED = {
    "count": lambda c: F.sum(c("n")),
    "sum": lambda c: F.sum(c("s")),
    "min": lambda c: F.min(c("v")),
    "max": lambda c: F.max(c("v")),
    "avg": lambda c: F.try_divide(F.sum(c("s")).cast("double"), F.sum(c("n")).cast("double")),
    "approx_distinct": lambda c: F.hll_sketch_estimate(F.hll_union_agg(c("h"))),
}


@dataclass(frozen=True)
class AggregateView:
    """``groups`` (column names) and ``measures`` of the view stored at ``path``."""
    path: str
    groups: tuple[str, ...]
    measures: dict[str, tuple[str, str | None]]

    def __post_init__(self) -> None:
        wrong = [n for n in (*self.groups, *self.measures) if n.startswith("_")]
        unknown = [f for f, _ in self.measures.values() if f not in PARTIAL]
        if wrong or unknown:
            raise ValueError(f"names starting with '_': {wrong}; unknown functions: {unknown}")

    def _partials(self, rows: DataFrame) -> DataFrame:
        made: list[Column] = []
        for name, (function, x) in self.measures.items():
            parts = PARTIAL[function](None if x is None else F.expr(x))
            made += [c.alias(f"_{name}_{k}") for k, c in parts.items()]
        return rows.groupBy(FILE, *self.groups).agg(*made)

    def refresh(self, listing: DataFrame, read: Callable[[DataFrame], DataFrame]) -> int:
        """Bring the view up to ``listing`` (``file_id``, ``modified``): ``read`` gets the rows of the listing that
        must be read and returns their data with a column ``_file`` (the ``file_id``). Returns the number
        of files that were read or removed."""
        spark = listing.sparkSession
        listed = listing.select(F.col("file_id").alias(FILE), F.col("modified").alias(MODIFIED)).groupBy(FILE).agg(
            F.max(MODIFIED).alias(MODIFIED))
        known = self._known(spark)
        if known is None:
            changed = listed.withColumn("_gone", F.lit(False))
        else:
            old = known.select(FILE, F.col(MODIFIED).alias("_was"))
            changed = listed.withColumn("_here", F.lit(True)).join(old, FILE, "full_outer").where(
                "_here IS NULL OR _was IS NULL OR _modified > _was").select(FILE, MODIFIED, F.col("_here").isNull().alias("_gone"))
        # the list of changed files is written: what is read, removed and recorded must be the same list
        stage = f"{self.path.rstrip('/')}.__changed"
        changed.write.mode("overwrite").parquet(stage)
        changed = spark.read.schema(changed.schema).parquet(stage)
        n = changed.count()
        if not n:
            return 0
        todo = changed.where("NOT _gone").select(FILE, MODIFIED)
        wanted = listing.join(todo.select(F.col(FILE).alias("file_id")), "file_id", "left_semi")
        partials = self._partials(read(wanted))
        heads = todo.withColumn("_head", F.lit(True))
        batch = partials.withColumn("_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
        replace_by_key(batch, self.path, FILE, ids=changed)
        return n

    def _known(self, spark: SparkSession) -> DataFrame | None:
        if not path_exists(spark, self.path):
            return None
        try:
            return read_replaced(spark, self.path, FILE).where("_head").select(FILE, MODIFIED)
        except FileNotFoundError:  # a first refresh that died
            return None

    def read(self, spark: SparkSession) -> DataFrame:
        """The view: its groups and measures."""
        rows = read_replaced(spark, self.path, FILE).where("NOT _head")
        merged = [MERGED[f](lambda k, name=name: F.col(f"`_{name}_{k}`")).alias(name) for name, (f, _) in self.measures.items()]
        return rows.groupBy(*self.groups).agg(*merged)
