"""Registry pairing each query with its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c) -> Column:
    """Doubles are compared at 6 decimals on both sides."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def ts_text(c) -> Column:
    """Timestamps are compared as text."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def ts_text_ms(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss.SSS")


def load_all() -> None:
    """Import every query module (each registers itself)."""
    from alpina.plans import (  # noqa: F401
        q_sources, q_sinks, q_columns, q_joins, q_aggregates, q_windows, q_streaming, q_flows,
    )
