"""Queries for change detection and key-based joins."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.functions.geo import grid_cell
from alpina.operators.changes import (
    changed_by_checksum, changed_by_epoch, changed_by_size_time, changed_by_time, delete_semi,
    missing_by_name,
)
from alpina.operators.point_grid import points_in_cells
from alpina.plans.fixtures import LISTING_SQL, orders_ledger, orders_listing
from alpina.plans.registry import query, table


@query("changed_by_time", f"""
WITH {LISTING_SQL},
last AS (SELECT file_id, max(modified_time) AS m FROM ledger GROUP BY file_id)
SELECT l.file_id, l.file_name, l.modified_time, l.size
FROM listing l LEFT JOIN last ON l.file_id = last.file_id
WHERE last.file_id IS NULL OR l.modified_time > last.m""")
def q_changed_by_time(spark: SparkSession, sf: str):
    listing = orders_listing(spark, sf).drop("modified_at")
    ledger = orders_ledger(spark, sf)
    return changed_by_time(listing, ledger, target="bronze_orders")


@query("changed_by_epoch", f"""
WITH {LISTING_SQL},
last AS (SELECT file_id, epoch(max(strptime(modified_time, '%Y-%m-%dT%H:%M:%SZ'))) AS m FROM ledger GROUP BY file_id),
l2 AS (SELECT *, strptime(modified_time, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 250 MILLISECOND AS modified_at FROM listing)
SELECT l2.file_id, l2.file_name, l2.size
FROM l2 LEFT JOIN last ON l2.file_id = last.file_id
WHERE last.file_id IS NULL OR floor(epoch(l2.modified_at)) > last.m""")
def q_changed_by_epoch(spark: SparkSession, sf: str):
    """Listing times carry +250 ms: sub-second differences must stay invisible."""
    listing = orders_listing(spark, sf).withColumn(
        "modified_at", F.col("modified_at") + F.expr("INTERVAL 250 MILLISECONDS"))
    ledger = orders_ledger(spark, sf).withColumn(
        "modified_time", F.to_timestamp("modified_time", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    out = changed_by_epoch(listing, ledger, modified_col="modified_at", target="bronze_orders")
    return out.select("file_id", "file_name", "size")


@query("changed_by_checksum", """
WITH assets AS (
  SELECT 'docs/' || doc_id AS path, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE sha256(text) END AS checksum FROM documents),
manifest AS (
  SELECT 'docs/' || doc_id AS path, CASE WHEN doc_id % 4 = 0 THEN sha256(text || '.') ELSE sha256(text) END AS checksum
  FROM documents WHERE doc_id % 3 <> 0)
SELECT a.path, a.checksum FROM assets a LEFT JOIN manifest m ON a.path = m.path
WHERE NOT (a.checksum IS NOT NULL AND coalesce(a.checksum = m.checksum, false))""")
def q_changed_by_checksum(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents")
    path = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"))
    assets = d.select(path.alias("path"), F.when(F.pmod("doc_id", F.lit(10)) == 0, F.lit(None).cast("string"))
                      .otherwise(F.sha2("text", 256)).alias("checksum"))
    manifest = d.where(F.pmod("doc_id", F.lit(3)) != 0).select(
        path.alias("path"),
        F.when(F.pmod("doc_id", F.lit(4)) == 0, F.sha2(F.concat("text", F.lit(".")), 256))
         .otherwise(F.sha2("text", 256)).alias("checksum"))
    return changed_by_checksum(assets, manifest, force=False)


@query("changed_by_size_time", """
WITH src AS (SELECT 'd' || doc_id || '.csv' AS name, n_chars AS size,
                    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) AS modified FROM documents),
dst AS (SELECT 'd' || doc_id || '.csv' AS name,
               CAST(CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS VARCHAR) AS source_size,
               CASE WHEN doc_id % 7 = 0 THEN NULL
                    WHEN doc_id % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id - 1 AS BIGINT))
                    ELSE TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS BIGINT)) END AS source_modified
        FROM documents WHERE doc_id % 11 <> 0)
SELECT s.name, s.size FROM src s LEFT JOIN dst d ON s.name = d.name
WHERE NOT (d.name IS NOT NULL AND coalesce(d.source_size = CAST(s.size AS VARCHAR), false)
           AND d.source_modified IS NOT NULL AND coalesce(d.source_modified >= s.modified, false))""")
def q_changed_by_size_time(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents")
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".csv"))
    t0 = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    src = d.select(name.alias("name"), F.col("n_chars").alias("size"),
                   F.timestamp_add("MINUTE", F.col("doc_id"), t0).alias("modified"))
    dst = d.where(F.pmod("doc_id", F.lit(11)) != 0).select(
        name.alias("name"),
        F.when(F.pmod("doc_id", F.lit(5)) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
         .cast("string").alias("source_size"),
        F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit(None).cast("timestamp"))
         .when(F.pmod("doc_id", F.lit(3)) == 0, F.timestamp_add("MINUTE", F.col("doc_id") - 1, t0))
         .otherwise(F.timestamp_add("MINUTE", F.col("doc_id"), t0)).alias("source_modified"))
    return changed_by_size_time(src, dst).select("name", "size")


@query("missing_by_name", """
SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def q_missing_by_name(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents").select("doc_id", "lang")
    lab = table(spark, sf, "labels")
    return missing_by_name(d, lab, name_col="doc_id")


@query("delete_semi", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45)""")
def q_delete_semi(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    batch = table(spark, sf, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 45))
    return delete_semi(o, batch, id_col="o_orderkey", batch_id="l_orderkey")


@query("point_grid_join", """
WITH pts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(floor(l_extendedprice / 1000) * 1000 AS BIGINT) AS cell_e,
         CAST(floor(l_quantity * 100 / 1000) * 1000 AS BIGINT) AS cell_n
  FROM lineitem),
cells AS (
  SELECT CAST(floor(l_extendedprice / 1000) * 1000 AS BIGINT) AS cell_e,
         CAST(floor(l_quantity * 100 / 1000) * 1000 AS BIGINT) AS cell_n,
         count(*) AS cell_rows, round(avg(l_discount), 6) AS cell_discount
  FROM lineitem GROUP BY 1, 2)
SELECT p.l_orderkey, p.l_linenumber, p.l_partkey, p.l_suppkey, p.cell_e, p.cell_n, c.cell_rows, c.cell_discount
FROM pts p JOIN cells c ON p.cell_e = c.cell_e AND p.cell_n = c.cell_n""")
def q_point_grid_join(spark: SparkSession, sf: str):
    """Line items as points, joined to the statistics of the cells they lie in."""
    li = table(spark, sf, "lineitem")
    e, n = F.col("l_extendedprice"), F.col("l_quantity") * 100
    g = grid_cell(e, n, 1000)
    cells = li.groupBy(g["cell_e"].alias("cell_e"), g["cell_n"].alias("cell_n")).agg(
        F.count(F.lit(1)).alias("cell_rows"), F.round(F.avg("l_discount"), 6).alias("cell_discount"))
    pts = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    return points_in_cells(pts, cells, e, n, 1000).drop("l_extendedprice", "l_quantity")
