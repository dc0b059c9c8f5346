"""Helpers shared by the operators: staging on shared storage and row packing."""

from __future__ import annotations

import os
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.session import delete_path, scratch_path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def importable(spark: SparkSession) -> None:
    """Let Python workers started from now on find this library where the driver has it (a cluster
    without a common folder gets it by --py-files or an installed package)."""
    root, env = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_scopes = threading.local()


def _staged_in() -> list[list[str]]:
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the cluster's shared folder and read it back.

    Cuts the lineage at files that survive the loss of any executor, and gives the next plan a
    plain scan (so adaptive execution can split skewed join sides). The write's own shuffle files
    are no longer needed afterwards; Spark removes them when it ends. The table stays until the :func:`temporary` block it was
    written in ends; without one, for good (it belongs to a result that is read later)."""
    path = scratch_path(df.sparkSession, name)
    if _staged_in():
        _staged_in()[-1].append(path)
    return _written(df, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end."""
    _staged_in().append([])
    try:
        yield
    finally:
        for path in _staged_in().pop():
            delete_path(spark, path)


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The staged result of ``build``; the tables it staged on the way are deleted."""
    path = scratch_path(spark, name)
    with temporary(spark):
        out = _written(build(), path)
    if _staged_in():
        _staged_in()[-1].append(path)
    return out


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct: work columns beside it can never clash with them."""
    return F.struct(*[F.col(_quoted(c)).alias(c) for c in df.columns]).alias(name)


def unpacked(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    return df.select(*[F.col(f"{name}.{_quoted(c)}").alias(c) for c in columns])


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"
