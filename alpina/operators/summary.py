"""Outcome counts with capped examples, and one-row control summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcome_counts(df: DataFrame, status_col: str, classes: Sequence[str], example_col: str,
                   max_examples: int = 5) -> DataFrame:
    """Count per outcome class (fixed classes appear with 0), plus up to ``max_examples``
    smallest example values per class.

    One scan and one small aggregate: every map task reduces its rows to a count and at most
    ``max_examples`` examples per class before anything is shuffled."""
    spark = df.sparkSession
    kind = df.schema[example_col].dataType.simpleString()

    def reduce_rows(batches):
        import heapq
        counts: dict = {}
        least: dict = {}
        for batch in batches:
            batch = batch.astype({"status": object})
            batch["status"] = batch["status"].where(batch["status"].notna(), None)
            for status, part in batch.groupby("status", dropna=False, sort=False):
                status = None if status != status else status
                counts[status] = counts.get(status, 0) + len(part)
                ex = part["ex"].dropna()
                least[status] = heapq.nsmallest(max_examples, [*least.get(status, []), *ex.nsmallest(max_examples).tolist()]
                                                if ex.dtype != object else [*least.get(status, []), *sorted(ex)[:max_examples]])
        import pandas as pd
        if counts:
            yield pd.DataFrame({"status": list(counts), "n": list(counts.values()), "ex": [least[s] for s in counts]})

    rows = df.select(F.col(status_col).cast("string").alias("status"), F.col(example_col).alias("ex"))
    partial = rows.mapInPandas(reduce_rows, f"status string, n long, ex array<{kind}>")
    fixed = spark.createDataFrame([(c,) for c in classes], "status string").select(
        "status", F.lit(0).cast("long").alias("n"), F.array().cast(f"array<{kind}>").alias("ex"))
    return (partial.unionByName(fixed).groupBy("status")
            .agg(F.sum("n").alias("n"),
                 F.slice(F.array_sort(F.flatten(F.collect_list("ex"))), 1, max_examples).alias("examples")))


def control_summary(**aggregates: tuple[DataFrame, dict]) -> DataFrame:
    """One row of control numbers from several tables: one aggregate per table (each is scanned once),
    one row each, folded into one row."""
    parts = [df.agg(*[c.alias(n) for n, c in columns.items()]) for df, columns in aggregates.values()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])
