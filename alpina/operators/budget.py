"""Budget-bounded prefix in a global order, computed without a single-partition window.

1. Range bounds are taken once from a sample of the order key and become literals of the plan. Every row's
   range number is an expression of its own key, so all jobs (and retried tasks) see the same ranges; the
   sample decides balance only, never a result.
2. One total per range comes to the driver (bounded by the range count, never by the data).
3. The running total is the range's offset (sum of the ranges before it) plus a window sum inside the
   range: one shuffle of the table, built-in functions only.

Sizes are non-negative, so "admit until the budget is first exceeded, then nothing more"
equals "global running total ≤ budget − reserve".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLED_PER_RANGE = 40


def _bounds(df: DataFrame, order_cols: list[str], ranges: int) -> DataFrame | None:
    """One row holding the sorted array of range bounds, from a bounded sample (None: one range)."""
    rows = df.count()
    want = SAMPLED_PER_RANGE * ranges
    if ranges < 2 or rows == 0:
        return None
    key = F.struct(*order_cols)
    sample = df.select(key.alias("k")).sample(fraction=min(1.0, want / rows), seed=17).limit(2 * want)
    picked = sample.agg(F.array_sort(F.collect_list("k")).alias("ks"))
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)),
                     lambda i: F.get("ks", F.floor(i * F.size("ks") / ranges).cast("int")))
    return picked.select(F.array_distinct(F.filter(at, lambda k: k.isNotNull())).alias("bounds"))


def _range_number(bounds: Column, n: int, key: Column) -> Column:
    """How many bounds are at most the key: a binary search over a literal array."""
    steps = [1 << p for p in range(max(0, n.bit_length() - 1), -1, -1)]
    hit = lambda at, s: (at + s <= n) & (F.get(bounds, at + s - 1) <= key)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, s: F.when(hit(at, s), at + s).otherwise(at))


def budget_prefix(df: DataFrame, size_col: str, order_cols: list[str], budget: int | None,
                  reserve: int = 0, num_ranges: int | None = None,
                  running_col: str = "running_bytes") -> DataFrame:
    """Rows admitted in ``order_cols`` order while the running size total stays within
    ``budget - reserve``; ``budget=None`` admits everything. ``order_cols`` must be a total
    order (unique). Adds ``running_col`` (the global running total, BIGINT)."""
    ranges = num_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = df.columns
    size = F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    found = _bounds(df, order_cols, ranges)
    bounds = found.first()["bounds"] if found is not None else []
    if bounds:
        kind = found.schema["bounds"].dataType
        literal = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                                       for v, f in zip(b, kind.elementType.fields, strict=True)]) for b in bounds])
        number = _range_number(literal, len(bounds), F.struct(*order_cols))
    else:
        number = F.lit(0)
    ranged = df.select("*", number.alias("_range"), size.alias("_size"))
    totals = {r["_range"]: r["t"] for r in ranged.groupBy("_range").agg(F.sum("_size").alias("t")).collect()}
    offsets, acc = [], 0
    for r in range(len(bounds) + 1):
        offsets.append(acc)
        acc += totals.get(r, 0)
    inside = Window.partitionBy("_range").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offset = F.get(F.array(*[F.lit(o).cast("long") for o in offsets]), F.col("_range"))
    out = ranged.withColumn(running_col, (offset + F.sum("_size").over(inside)).cast("long"))
    if budget is not None:
        out = out.where(F.col(running_col) <= budget - reserve)
    return out.select(*columns, running_col)
