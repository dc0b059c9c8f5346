"""Continuous file ingestion into append-only bronze tables.

``readStream`` over a file glob with an explicit schema, file lineage from ``_metadata``,
append sink with a checkpoint on shared storage; ``availableNow`` drains what is there and
stops (the batch-style trigger), ``processingTime`` keeps running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from alpina.sources.files import LINEAGE_PLAIN


def stream_files(spark: SparkSession, glob: str, schema: StructType, fmt: str = "csv",
                 options: dict | None = None) -> DataFrame:
    """Streaming scan of files matching a glob (a single-file path is not accepted by the file
    source — use a glob)."""
    r = spark.readStream.format(fmt).schema(schema)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load(glob)


def bronze_stream(spark: SparkSession, glob: str, schema: StructType, fmt: str = "csv",
                  options: dict | None = None, lineage=LINEAGE_PLAIN) -> DataFrame:
    """All-STRING (or given) columns plus source file, its modification time, ingestion time."""
    f, m, i = lineage
    return stream_files(spark, glob, schema, fmt, options).select(
        "*",
        F.col("_metadata.file_path").alias(f),
        F.col("_metadata.file_modification_time").alias(m),
        F.current_timestamp().alias(i))


def run_append(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
               available_now: bool = True, name: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append sink with a checkpoint; with ``available_now`` (and ``wait``) it returns once the
    input present at start is drained."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start(out_path)
    if available_now and wait:
        q.awaitTermination()
    return q


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      output_mode: str = "append", available_now: bool = True) -> StreamingQuery:
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(fn))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def dropped_counts(query: StreamingQuery, name: str) -> dict[str, int]:
    """Sums of the metrics observed under ``name`` over the query's reported progress."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(name)
        for k, v in (row.asDict() if row is not None else {}).items():
            total[k] = total.get(k, 0) + v
    return total
