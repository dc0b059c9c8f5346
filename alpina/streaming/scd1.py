"""SCD type 1 upserts on a stream, without MERGE.

Both kinds write their batches into a :class:`~alpina.sinks.keyed.KeyedTable`, which keeps the newest row per key in hash buckets: late
older rows lose, and a NULL in the newest row overwrites (whole-row semantics). Buckets that have gathered many files are folded between
batches by the stream itself.

* :func:`start_scd1` keeps no state: a batch is reduced to its newest row per key and written as it is.
* :func:`start_scd1_state` keeps the winner of every key in a RocksDB state store (changelog checkpoints). Its batches hold what has
  won over all batches so far, so every row that a batch writes is right by itself and may be sent on, which a
  stateless batch's is not. The state grows with the number of keys, on the executors' disks.

A batch is named by the checkpoint's own id and its number: a replayed batch is there already, and a new checkpoint never meets
the batches of an old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alpina.operators.dedupe import latest_per_key
from alpina.session import path_exists, read_text_file, write_text_file
from alpina.sinks.keyed import BUCKETS, FOLD_AFTER, KEEP_SECONDS, KeyedTable
from alpina.streaming.bronze import run_foreach_batch

SOURCE_ID = "_source_id"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def scd1_latest(rows: DataFrame, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Winner per key by (sequence…, then the whole row) descending."""
    return latest_per_key(rows, keys, [F.col(s) for s in sequence], drop_null_keys=False)


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """An id that lives and dies with the checkpoint."""
    path = f"{checkpoint.rstrip('/')}/{SOURCE_ID}"
    if not path_exists(spark, path):
        write_text_file(spark, path, uuid.uuid4().hex[:12])
    return read_text_file(spark, path).strip()


def _upsert(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], target: str, checkpoint: str, mode: str,
            available_now: bool, buckets: int, fold_after: int, keep_seconds: float) -> StreamingQuery:
    source = checkpoint_id(stream.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        table = KeyedTable(batch.sparkSession, target, keys, sequence, buckets)
        table.write(batch, f"{source}-{batch_id}")
        table.maintain(fold_after, keep_seconds)

    return run_foreach_batch(stream, write, checkpoint, output_mode=mode, available_now=available_now)


def start_scd1(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], target: str, checkpoint: str,
               available_now: bool = True, *, buckets: int = BUCKETS, fold_after: int = FOLD_AFTER,
               keep_seconds: float = KEEP_SECONDS) -> StreamingQuery:
    """Start (and with ``available_now`` drain) the stateless upsert stream."""
    return _upsert(stream, keys, sequence, target, checkpoint, "append", available_now, buckets, fold_after, keep_seconds)


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_scd1_state(stream: DataFrame, keys: Sequence[str], sequence: Sequence[str], target: str, checkpoint: str,
                     available_now: bool = True, *, state_partitions: int | None = None, buckets: int = BUCKETS,
                     fold_after: int = FOLD_AFTER, keep_seconds: float = KEEP_SECONDS) -> StreamingQuery:
    """Start (and with ``available_now`` drain) the upsert stream with state. ``state_partitions`` counts at the checkpoint's
    first start (Spark keeps it); the stream's columns are fixed with its state, so a new column takes a new checkpoint."""
    spark = stream.sparkSession
    settings = dict(STATE_CONF)
    if state_partitions:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    with _conf(spark, settings):  # a query takes the session's settings when it starts
        return _upsert(scd1_latest(stream, keys, sequence), keys, sequence, target, checkpoint, "update", available_now,
                       buckets, fold_after, keep_seconds)


def state_size(query: StreamingQuery) -> dict[str, int]:
    """Keys held, bytes of memory and bytes of RocksDB files of the query's state, after its last batch with data."""
    for progress in reversed(query.recentProgress):
        if progress.stateOperators:
            ops = progress.stateOperators
            return {"keys": sum(o.numRowsTotal for o in ops), "memory_bytes": sum(o.memoryUsedBytes for o in ops),
                    "file_bytes": sum((o.customMetrics or {}).get("rocksdbSstFileSize", 0)
                                      + (o.customMetrics or {}).get("rocksdbTotalBytesWritten", 0) for o in ops)}
    return {"keys": 0, "memory_bytes": 0, "file_bytes": 0}


def read_scd1(spark: SparkSession, target: str, keys: Sequence[str], sequence: Sequence[str]) -> DataFrame:
    """Current table: the newest row per key, bucket by bucket (no exchange)."""
    return KeyedTable(spark, target, keys, sequence).read()


def compact_scd1(spark: SparkSession, target: str, keys: Sequence[str], sequence: Sequence[str]) -> list[int]:
    """Fold every bucket that has more than one file; returns the buckets. Safe beside a running stream and open readers."""
    return KeyedTable(spark, target, keys, sequence).fold()
