"""Data-quality expectations and quarantine.

Expectations drop violating rows and count them with ``Observation`` (metrics travel with
the job that runs anyway, no extra pass). Quarantine keeps the unit of failure a *file*:
a file with any corrupt record is rejected whole; good files still load; the caller raises
after both sides are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def expect_or_drop(df: DataFrame, expectations: dict[str, str],
                   name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep rows satisfying every SQL predicate. A NULL predicate result counts as a violation
    (the row is dropped). Returns the frame and an Observation whose ``get`` gives
    ``{"<name>_dropped": n, ...}`` once an action ran."""
    obs = Observation(name)
    metrics = [F.count_if(~F.coalesce(F.expr(p), F.lit(False))).alias(f"{n}_dropped")
               for n, p in expectations.items()]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows_in"), *metrics)
    cond = F.lit(True)
    for p in expectations.values():
        cond = cond & F.coalesce(F.expr(p), F.lit(False))
    return observed.where(cond), obs


def expectation_flags(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Adds one boolean column per expectation (``_ok_<name>``), for streams and reports."""
    return df.select("*", *[F.coalesce(F.expr(p), F.lit(False)).alias(f"_ok_{n}")
                            for n, p in expectations.items()])


def split_corrupt_files(parsed: DataFrame, stage_path: str, file_col: str = "_source_file",
                        corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good rows, error rows) with whole-file rejection.

    The parsed rows are first written once to ``stage_path`` (Spark refuses to filter a raw
    JSON/CSV scan on its corrupt-record column alone, and the stage also cuts the lineage so
    both sides read the same parse). Files with at least one corrupt record go to the error
    side as one row ``(file, n_corrupt, message)``; all rows of clean files go to the good
    side."""
    parsed.write.mode("overwrite").parquet(stage_path)
    parsed = parsed.sparkSession.read.parquet(stage_path)
    bad_files = (parsed.where(F.col(corrupt_col).isNotNull())
                 .groupBy(F.col(file_col).alias("file"))
                 .agg(F.count(F.lit(1)).alias("n_corrupt"),
                      F.min(corrupt_col).alias("example")))
    errors = bad_files.select("file", "n_corrupt",
                              F.concat(F.lit("corrupt record: "), F.col("example")).alias("message"))
    good = (parsed.join(bad_files.select(F.col("file").alias("_bf")),
                        parsed[file_col] == F.col("_bf"), "left_anti")
            .drop(corrupt_col))
    return good, errors


class NameCollision(ValueError):
    """Two column names of one file become the same cleaned name."""


class QuarantineError(RuntimeError):
    """Raised after good and bad inputs were both written, so the run ends failed."""
