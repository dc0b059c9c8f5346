"""Queries for Structured Streaming operators and quarantine (§2.10).

Each drains its stream with ``availableNow`` into a sink below the shared scratch folder and
returns a batch read of the sink, so stream and batch results can be compared."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alpina.functions.casts import cast_double_strict
from alpina.functions.timeparse import parse_ts_strict
from alpina.operators.projection import drop_null_keys
from alpina.operators.quality import QuarantineError, expectation_flags, split_corrupt_files
from alpina.plans.q_columns import EVENT_EXPECTATIONS
from alpina.plans.registry import query, r6, table, ts_text, ts_text_ms
from alpina.session import delete_path, list_dir, scratch_path
from alpina.sinks.tables import rename_path
from alpina.sources.delimited import write_delimited
from alpina.sources.files import with_lineage
from alpina.sources.json_text import read_json_strings
from alpina.streaming.bronze import bronze_stream, dropped_counts, run_append, stream_files
from alpina.streaming.quarantine import read_side, run_quarantined
from alpina.streaming.scd1 import read_scd1, start_scd1, start_scd1_state, state_size
from alpina.streaming.versions import read_bronze, start_bronze

LATEST_EVENTS_SQL = """
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, round(value, 6) AS value
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"""


def _land_events(spark: SparkSession, sf: str, files: int = 4) -> str:
    """Events landed as several parquet files, each holding a mix of old and new rows, so
    later micro-batches carry late (older) rows."""
    root = scratch_path(spark, "events_landing")
    e = table(spark, sf, "events")
    e.repartition(files, F.pmod("event_id", F.lit(files))).write.mode("overwrite").parquet(root)
    return root


@query("stream_bronze", """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, user_id, event_type, round(value, 6) AS value,
       'events.parquet' AS source_name
FROM events""")
def q_stream_bronze(spark: SparkSession, sf: str):
    glob = f"{sf.rstrip('/')}/events*.parquet"
    schema = spark.read.parquet(glob).schema
    out, ck = scratch_path(spark, "bronze_events"), scratch_path(spark, "ck_bronze_events")
    run_append(bronze_stream(spark, glob, schema, fmt="parquet"), out, ck)
    b = spark.read.parquet(out)
    return b.select("event_id", ts_text_ms("ts").alias("ts"), "user_id", "event_type", r6("value").alias("value"),
                    F.regexp_extract("source_file", r"([^/]+)$", 1).alias("source_name"))


ORDERS_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _deliver(df, folder: str, name: str) -> None:
    """Write a delivery of CSV files aside and move them to ``<folder>/<name>-<k>.csv``, over those of an earlier one."""
    spark = df.sparkSession
    aside = scratch_path(spark, "delivery")
    write_delimited(df, aside, sep=";")
    for k, part in enumerate(sorted(n for n in list_dir(spark, aside) if n.endswith(".csv"))):
        delete_path(spark, f"{folder}/{name}-{k}.csv")
        rename_path(spark, f"{aside}/{part}", f"{folder}/{name}-{k}.csv")


@query("stream_reingest", """
WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
                  CAST(o_totalprice + 1 AS VARCHAR) AS raised, o_orderpriority, o_orderkey % 4 AS file FROM orders)
SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS clerk, NULL::VARCHAR AS rescued, CAST(0 AS BIGINT) AS batch FROM o
UNION ALL
SELECT o_orderkey, raised, 'clerk ' || o_orderkey, o_orderpriority, 1 FROM o WHERE file = 1""")
def q_stream_reingest(spark: SparkSession, sf: str):
    """Orders land as files by key; one group of files is overwritten at the same paths with changed prices, one more column and
    lines of one field more than the header has. The stream, restarted from its checkpoint, reads just those again."""
    o = table(spark, sf, "orders")
    root, out, ck = (scratch_path(spark, n) for n in ("orders_landing", "bronze_orders", "ck_bronze_orders"))
    text = o.select(*[F.col(c).cast("string").alias(c) for c in ORDERS_TEXT], F.pmod("o_orderkey", F.lit(4)).alias("file"),
                    (F.col("o_totalprice") + 1).cast("string").alias("raised"))
    for file in range(4):
        _deliver(text.where(F.col("file") == file).select(*ORDERS_TEXT), root, f"orders-{file}")
    run = lambda: start_bronze(spark, root, "*.csv", out, ck, settle_ms=0)
    run()
    second = text.where("file = 1").select(
        "o_orderkey", F.col("raised").alias("o_totalprice"),
        F.concat(F.lit("clerk "), "o_orderkey", F.lit(";"), "o_orderpriority").alias("clerk"))
    lines = second.select(F.concat_ws(";", "o_orderkey", "o_totalprice", "clerk").alias("o_orderkey;o_totalprice;clerk"))
    aside = scratch_path(spark, "delivery")
    lines.write.option("header", True).option("sep", "\u0001\u0002").option("quoteAll", False).option("escapeQuotes", False).csv(aside)
    for name in list_dir(spark, root):
        if name.startswith("orders-1-"):
            delete_path(spark, f"{root}/{name}")
    for k, part in enumerate(sorted(n for n in list_dir(spark, aside) if n.endswith(".csv"))):
        rename_path(spark, f"{aside}/{part}", f"{root}/orders-1-{k}.csv")
    run()
    run()  # nothing new: no batch
    return read_bronze(spark, out).select("o_orderkey", "o_totalprice", "clerk", F.try_element_at("_rescued", F.lit("_c3")).alias("rescued"),
                                          F.col("_batch").alias("batch"))


@query("stream_scd1", LATEST_EVENTS_SQL)
def q_stream_scd1(spark: SparkSession, sf: str):
    root = _land_events(spark, sf)
    schema = spark.read.parquet(root).schema
    s = stream_files(spark, root, schema, "parquet", {"maxFilesPerTrigger": 1}) \
        .select("user_id", "event_type", "event_id", "ts", "value")
    target, ck = scratch_path(spark, "silver_events"), scratch_path(spark, "ck_silver_events")
    start_scd1(s, ["user_id", "event_type"], ["ts", "event_id"], target, ck)
    out = read_scd1(spark, target, ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id", ts_text_ms("ts").alias("ts"), r6("value").alias("value"))


@query("stream_scd1_state", LATEST_EVENTS_SQL)
def q_stream_scd1_state(spark: SparkSession, sf: str):
    """The upsert with the winners in a RocksDB state store: the landed files arrive one per batch, in two runs of one
    checkpoint; the second run re-delivers half of the rows."""
    keys, sequence = ["user_id", "event_type"], ["ts", "event_id"]
    root = _land_events(spark, sf)
    schema = spark.read.parquet(root).schema
    target, ck = scratch_path(spark, "silver_events"), scratch_path(spark, "ck_silver_events")
    for again in (False, True):
        if again:
            table(spark, sf, "events").where("event_id % 2 = 0").repartition(2).write.mode("append").parquet(root)
        s = stream_files(spark, root, schema, "parquet", {"maxFilesPerTrigger": 2}).select("user_id", "event_type", "event_id", "ts", "value")
        query = start_scd1_state(s, keys, sequence, target, ck, state_partitions=8)
    held = state_size(query)["keys"]
    out = read_scd1(spark, target, keys, sequence)
    if held != out.count():
        raise RuntimeError(f"the state holds {held} keys")
    return out.select("user_id", "event_type", "event_id", ts_text_ms("ts").alias("ts"), r6("value").alias("value"))


EVENT_TEXT = ["event_id", "ts", "user_id", "event_type", "value"]


def _land_events_csv(spark, sf):
    root = scratch_path(spark, "events_csv")
    e = table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.date_format("ts", "dd.MM.yyyy HH:mm").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"), "event_type",
        F.col("value").cast("string").alias("value"))
    write_delimited(e, root, sep=";")
    return root


@query("stream_typed", """
SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS ts, user_id, upper(trim(event_type)) AS event_type,
       round(value, 6) AS value
FROM events""")
def q_stream_typed(spark: SparkSession, sf: str):
    root = _land_events_csv(spark, sf)
    schema = StructType([StructField(c, StringType()) for c in EVENT_TEXT])
    s = stream_files(spark, root, schema, "csv", {"header": "true", "sep": ";"})
    typed = s.select(F.col("event_id").cast("long").alias("event_id"), parse_ts_strict("ts").alias("ts"),
                     F.col("user_id").cast("long").alias("user_id"), F.upper(F.trim("event_type")).alias("event_type"),
                     cast_double_strict("value").alias("value"))
    typed = drop_null_keys(typed, ["event_id", "ts"])
    out, ck = scratch_path(spark, "typed_events"), scratch_path(spark, "ck_typed_events")
    run_append(typed, out, ck)
    b = spark.read.parquet(out)
    return b.select("event_id", ts_text("ts").alias("ts"), "user_id", "event_type", r6("value").alias("value"))


@query("stream_expect", """
SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events
WHERE value < 400 AND event_type IN ('click', 'view', 'purchase', 'error')""")
def q_stream_expect(spark: SparkSession, sf: str):
    root = _land_events(spark, sf)
    schema = spark.read.parquet(root).schema
    s = stream_files(spark, root, schema, "parquet").select("event_id", "user_id", "event_type", "value")
    flagged = expectation_flags(s, EVENT_EXPECTATIONS)
    oks = [F.col(f"_ok_{n}") for n in EVENT_EXPECTATIONS]
    counted = flagged.observe("expectations", F.count(F.lit(1)).alias("rows_in"),
                              *[F.count_if(~c).alias(f"{n}_dropped") for n, c in zip(EVENT_EXPECTATIONS, oks)])
    cond = oks[0]
    for c in oks[1:]:
        cond = cond & c
    kept = counted.where(cond).select("event_id", "user_id", "event_type", "value")
    out, ck = scratch_path(spark, "expect_events"), scratch_path(spark, "ck_expect_events")
    dropped = dropped_counts(run_append(kept, out, ck), "expectations")
    if set(dropped) != {"rows_in", *(f"{n}_dropped" for n in EVENT_EXPECTATIONS)}:
        raise RuntimeError(f"the stream reported {dropped}")
    return spark.read.parquet(out).withColumn("value", r6("value"))


@query("quarantine", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type
FROM events WHERE event_type <> 'error'""")
def q_quarantine(spark: SparkSession, sf: str):
    """NDJSON files per event type; the ``error`` file holds corrupt records and is rejected
    whole, the others load; the error set names the rejected file."""
    e = table(spark, sf, "events")
    root = scratch_path(spark, "events_json")
    body = F.to_json(F.struct("event_id", "user_id", "event_type"))
    line = F.when((F.col("event_type") == "error") & (F.pmod("event_id", F.lit(50)) == 0),
                  F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', broken')))\
        .otherwise(body)
    (e.select(line.alias("value"), F.col("event_type").alias("part")).hint("rebalance", "part")
     .write.mode("overwrite").partitionBy("part").text(root))
    parsed = with_lineage(read_json_strings(spark, root, multi_line=False, corrupt_col="_corrupt_record"))
    good, errors = split_corrupt_files(parsed, scratch_path(spark, "quarantine_stage"))
    errs = scratch_path(spark, "quarantine_errors")
    errors.write.mode("overwrite").parquet(errs)
    return good.select("event_id", "user_id", "event_type")


@query("stream_quarantine", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type
FROM events WHERE event_type <> 'error'""")
def q_stream_quarantine(spark: SparkSession, sf: str):
    """As ``quarantine``, file by file in a stream: the files of ``error`` hold corrupt records and are rejected whole, the stream
    goes on with those after them, and the run ends failed."""
    e = table(spark, sf, "events")
    root = scratch_path(spark, "events_json_stream")
    line = F.when((F.col("event_type") == "error") & (F.pmod("event_id", F.lit(5)) == 0),
                  F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit(', broken')))\
        .otherwise(F.to_json(F.struct("event_id", "user_id", "event_type")))
    (e.select(line.alias("value"), F.col("event_type").alias("part")).repartition("part")
     .write.partitionBy("part").text(root))
    schema = StructType([StructField(c, StringType()) for c in ("event_id", "user_id", "event_type", "_corrupt_record")])
    s = bronze_stream(spark, f"{root}/*/*.txt", schema, "json",
                      {"columnNameOfCorruptRecord": "_corrupt_record", "maxFilesPerTrigger": "2"})
    store, ck = scratch_path(spark, "quarantined"), scratch_path(spark, "ck_quarantined")
    try:
        run_quarantined(s, store, ck, file_col="source_file")
    except QuarantineError:
        if not read_side(spark, store, "errors").count():
            raise RuntimeError("rejected files are not in the error table") from None
    return read_side(spark, store, "good").select("event_id", "user_id", "event_type")
