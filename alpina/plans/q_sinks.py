"""Queries for sinks and table maintenance. Each writes below the shared
scratch folder and returns what a reader of the written table sees."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.plans.registry import query, r6, table
from alpina.session import scratch_path
from alpina.sinks.clustered import clustering_columns, in_box, insert_clustered
from alpina.sinks.ledger import LEDGER_SCHEMA, ledger_rows, merge_manifest, record_ledger
from alpina.sinks.tables import (
    append_evolving, create_typed_table, expire_partitions, full_refresh, materialize_view,
    overwrite_table, read_evolving, read_replaced, replace_by_key, write_dated_partitions,
)
from alpina.sinks.views import AggregateView
from alpina.sources.delimited import read_delimited, write_delimited
from alpina.sources.files import list_files


@query("append_evolving", """
SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 1 THEN c_nationkey END AS c_nationkey,
       CASE WHEN c_custkey % 2 = 1 THEN round(c_acctbal, 6) END AS c_acctbal
FROM customer""")
def q_append_evolving(spark: SparkSession, sf: str):
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "evolving")
    append_evolving(c.where(F.pmod("c_custkey", F.lit(2)) == 0).select("c_custkey", "c_name"), path)
    append_evolving(c.where(F.pmod("c_custkey", F.lit(2)) == 1)
                    .select("c_custkey", "c_name", "c_nationkey", r6("c_acctbal").alias("c_acctbal")), path)
    return read_evolving(spark, path).select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


@query("overwrite_table", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1, 2""")
def q_overwrite_table(spark: SparkSession, sf: str):
    """First build with one schema, then a full rebuild with another, read back."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "overwrite")
    overwrite_table(o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders")), path)
    overwrite_table(o.groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")), path)
    return spark.read.parquet(path)


@query("replace_by_key", """
WITH batch AS (SELECT o_orderkey, o_custkey, round(o_totalprice * 2, 6) AS o_totalprice FROM orders
               WHERE o_custkey % 7 = 0 AND o_orderkey % 2 = 0)
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM batch)
UNION ALL
SELECT * FROM batch""")
def q_replace_by_key(spark: SparkSession, sf: str):
    """Source id = customer; the batch re-delivers every seventh customer's orders with a
    doubled price and only the even order keys; applied twice (idempotence)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", r6("o_totalprice").alias("o_totalprice"))
    path = scratch_path(spark, "replace")
    replace_by_key(o, path, "o_custkey")
    batch = (table(spark, sf, "orders")
             .where((F.pmod("o_custkey", F.lit(7)) == 0) & (F.pmod("o_orderkey", F.lit(2)) == 0))
             .select("o_orderkey", "o_custkey", r6(F.col("o_totalprice") * 2).alias("o_totalprice")))
    replace_by_key(batch, path, "o_custkey")
    replace_by_key(batch, path, "o_custkey")
    return read_replaced(spark, path, "o_custkey")


@query("create_typed_table", """
SELECT CAST(s_suppkey AS VARCHAR) AS station_id, s_name AS label, CAST(s_nationkey AS INTEGER) AS canton,
       round(s_acctbal, 6) AS elevation
FROM supplier""")
def q_create_typed_table(spark: SparkSession, sf: str):
    loc = scratch_path(spark, "typed_table")
    name = "alpina_typed_" + loc.rsplit("-", 1)[-1]
    create_typed_table(spark, name, [
        ("station_id", "STRING", "station key"),
        ("label", "STRING", None),
        ("canton", "INT", "canton number"),
        ("elevation", "DOUBLE", "metres above sea level"),
    ], cluster_by=["canton"], comment="typed station table", location=loc)
    s = table(spark, sf, "supplier")
    s.select(F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("int"),
             r6("s_acctbal")).write.insertInto(name)
    return spark.table(name)


@query("write_dated_partitions", """
SELECT strftime(ts, '%Y-%m-%d') AS "date", count(*) AS n_events, round(sum(value), 6) AS total_value
FROM events GROUP BY 1""")
def q_write_dated_partitions(spark: SparkSession, sf: str):
    e = table(spark, sf, "events")
    path = scratch_path(spark, "dated_ndjson")
    write_dated_partitions(e, path, "ts")
    back = spark.read.json(path)
    return back.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 6).alias("total_value"))


@query("expire_partitions", """
SELECT strftime(ts, '%Y-%m-%d') AS "date", count(*) AS n_events
FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' GROUP BY 1""")
def q_expire_partitions(spark: SparkSession, sf: str):
    e = table(spark, sf, "events").select("event_id", "ts")
    path = scratch_path(spark, "retention")
    write_dated_partitions(e, path, "ts", fmt="parquet")
    # a folder outside the date pattern must survive retention
    e.where(F.col("event_id") < 0).write.mode("overwrite").parquet(f"{path}/_keep_me")
    expire_partitions(spark, path, datetime(2024, 1, 15))
    back = spark.read.parquet(path)
    return back.groupBy(F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("n_events"))


def _doc_listing(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("source").distinct().select(
        F.col("source").alias("file_id"), F.concat(F.lit("landing/"), "source", F.lit(".json")).alias("file_path"),
        F.concat(F.col("source"), F.lit(".json")).alias("file_name"),
        F.lit("2024-01-01T00:00:00Z").alias("modified_time"))


@query("record_ledger", """
WITH files AS (SELECT DISTINCT source FROM documents),
loaded AS (SELECT source, count(*) AS n FROM documents WHERE lang = 'de' AND n_chars > 20000 GROUP BY source)
SELECT f.source AS file_id, 'landing/' || f.source || '.json' AS file_path, 'bronze_docs' AS target_table,
       coalesce(l.n, 0) AS row_count
FROM files f LEFT JOIN loaded l ON f.source = l.source""")
def q_record_ledger(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents")
    loaded = d.where((F.col("lang") == "de") & (F.col("n_chars") > 20000)).select(F.col("source").alias("_source_file_id"))
    path = scratch_path(spark, "ledger")
    record_ledger(ledger_rows(_doc_listing(spark, sf), loaded, "bronze_docs"), path)
    return spark.read.parquet(path).select("file_id", "file_path", "target_table", "row_count")


@query("merge_manifest", """
WITH old AS (SELECT 'c' || c_custkey AS path, c_name AS name, round(c_acctbal, 6) AS bal FROM customer),
new AS (SELECT 'c' || (c_custkey + 100) AS path, c_name AS name, round(c_acctbal + 1, 6) AS bal FROM customer)
SELECT coalesce(n.path, o.path) AS path,
       CASE WHEN n.path IS NOT NULL THEN n.name ELSE o.name END AS name,
       CASE WHEN n.path IS NOT NULL THEN n.bal ELSE o.bal END AS bal
FROM old o FULL OUTER JOIN new n ON o.path = n.path""")
def q_merge_manifest(spark: SparkSession, sf: str):
    c = table(spark, sf, "customer")
    old = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("path"),
                   F.struct(F.col("c_name").alias("name"), r6("c_acctbal").alias("bal")).alias("record"))
    new = c.select(F.concat(F.lit("c"), (F.col("c_custkey") + 100).cast("string")).alias("path"),
                   F.struct(F.col("c_name").alias("name"), r6(F.col("c_acctbal") + 1).alias("bal")).alias("record"))
    m = merge_manifest(old, new)
    return m.select("path", "record.name", "record.bal")


@query("full_refresh", """
SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'tbl_' || o_orderpriority AS target_table
FROM orders WHERE o_orderpriority <> '1-URGENT'""")
def q_full_refresh(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders")
    ledger = scratch_path(spark, "ledger_fr")
    target = scratch_path(spark, "target_fr")
    o.select("o_orderkey").write.parquet(target)
    rows = o.select(F.col("o_orderkey").cast("string").alias("file_id"),
                    F.lit(None).cast("string").alias("file_path"), F.lit(None).cast("string").alias("file_name"),
                    F.lit(None).cast("string").alias("modified_time"),
                    F.concat(F.lit("tbl_"), "o_orderpriority").alias("target_table"),
                    F.lit(0).cast("long").alias("row_count"), F.current_timestamp().alias("ingested_at"))
    record_ledger(rows, ledger)
    full_refresh(spark, target, ledger, "tbl_1-URGENT")
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger).select("file_id", "target_table")


@query("materialize_view", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey,
       '_meta' AS source_folder
FROM nation""")
def q_materialize_view(spark: SparkSession, sf: str):
    n = table(spark, sf, "nation")
    root = scratch_path(spark, "meta")
    # the metadata folder starts with "_": directory discovery would skip it, an explicit path reads it
    write_delimited(n, f"{root}/_meta", sep=";", encoding="windows-1252")
    view = scratch_path(spark, "meta_view")
    src = read_delimited(spark, f"{root}/_meta", sep=";", encoding="windows-1252") \
        .withColumn("source_folder", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1))
    materialize_view(src, view)
    return spark.read.parquet(view)


@query("clustered_table", """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey, round(l_extendedprice, 6) AS l_extendedprice
FROM lineitem WHERE l_partkey BETWEEN 20 AND 60 AND l_extendedprice BETWEEN 10000 AND 30000""")
def q_clustered_table(spark: SparkSession, sf: str):
    """All line items stored along the curve of the table's own clustering columns; a bounding box is read back."""
    loc = scratch_path(spark, "clustered_table")
    name = "alpina_clustered_" + loc.rsplit("-", 1)[-1]
    create_typed_table(spark, name, [
        ("l_orderkey", "BIGINT", None), ("l_linenumber", "BIGINT", None), ("l_partkey", "BIGINT", "east"),
        ("l_extendedprice", "DOUBLE", "north")], cluster_by=["l_partkey", "l_extendedprice"], location=loc)
    li = table(spark, sf, "lineitem")
    insert_clustered(li.select("l_orderkey", "l_linenumber", "l_partkey", r6("l_extendedprice").alias("l_extendedprice")), name)
    if clustering_columns(spark, name) != ["l_partkey", "l_extendedprice"]:
        raise RuntimeError("the table lost its clustering columns")
    return in_box(spark.table(name), {"l_partkey": (20, 60), "l_extendedprice": (10000.0, 30000.0)})


@query("incremental_view", """
SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total, round(min(o_totalprice), 6) AS least,
       round(max(o_totalprice), 6) AS most, round(avg(o_totalprice), 4) AS mean
FROM orders GROUP BY o_orderpriority""")
def q_incremental_view(spark: SparkSession, sf: str):
    """A view over three deliveries: half of the statuses, the others, and the first half rewritten (its files first held
    prices ten times as high, so its old minimum and maximum must go)."""
    o = table(spark, sf, "orders").select("o_orderpriority", "o_totalprice", "o_orderstatus")
    root = scratch_path(spark, "view_source")
    view = AggregateView(scratch_path(spark, "view"), ("o_orderpriority",), {
        "n_orders": ("count", None), "total": ("sum", "o_totalprice"), "least": ("min", "o_totalprice"),
        "most": ("max", "o_totalprice"), "mean": ("avg", "o_totalprice")})

    def read(files):
        paths = [r["path"] for r in files.select("path").collect()]  # the files about to be opened
        if not paths:
            return o.limit(0).withColumn("_file", F.lit(""))
        return spark.read.schema(o.schema).parquet(*paths).withColumn("_file", F.regexp_extract("_metadata.file_path", r"([^/]+/[^/]+)$", 1))

    def refresh():
        listing = list_files(spark, root, "*.parquet").select(
            F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file_id"), "path", "modified")
        return view.refresh(listing, read)

    first = F.col("o_orderstatus") == "F"
    o.where(first).withColumn("o_totalprice", F.col("o_totalprice") * 10).write.parquet(f"{root}/closed")
    refresh()
    o.where(~first).write.parquet(f"{root}/open")
    refresh()
    o.where(first).write.mode("overwrite").parquet(f"{root}/closed")
    refresh()
    v = view.read(spark)
    return v.select("o_orderpriority", "n_orders", F.round("total", 2).alias("total"), r6("least").alias("least"),
                    r6("most").alias("most"), F.round("mean", 4).alias("mean"))
