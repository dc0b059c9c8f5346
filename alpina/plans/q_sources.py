"""Queries for the scan / source operators."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.operators.terrain import raster_to_pixels
from alpina.plans.registry import query, r6, table
from alpina.session import scratch_path
from alpina.sources.delimited import (
    read_charset_csv, read_delimited, read_delimited_union, write_delimited,
)
from alpina.sources.files import list_files, read_existing, read_parquet_typed, with_lineage
from alpina.sources.json_text import read_json_strings, to_json_lines
from alpina.sources.web import catalog_assets, extract_links, item_ids, parse_url_list


@query("read_delimited", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders""")
def q_read_delimited(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "orders_csv")
    write_delimited(o.select(*[F.col(c).cast("string").alias(c) for c in o.columns]), path, sep=";")
    return read_delimited(spark, path, sep=";", keep_empty=True)


@query("read_delimited_union", """
SELECT * FROM (
  SELECT CAST(c_custkey AS VARCHAR) AS "key", c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation,
         CAST(c_acctbal AS VARCHAR) AS acctbal, c_mktsegment AS segment, NULL::VARCHAR AS supplier_flag, NULL::VARCHAR AS third,
         NULL::VARCHAR AS fourth
  FROM customer
  UNION ALL
  SELECT CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR),
         NULL, 'Y', NULL, NULL
  FROM supplier
  UNION ALL
  SELECT 'n' || CAST(n_nationkey AS VARCHAR), CASE WHEN n_nationkey % 3 > 0 THEN n_name END, NULL, NULL, NULL, NULL,
         CASE WHEN n_nationkey % 3 = 2 THEN 'a;"b' END, CASE WHEN n_nationkey % 3 = 2 THEN CAST(n_regionkey AS VARCHAR) END
  FROM nation)""")
def q_read_delimited_union(spark: SparkSession, sf: str):
    """Three header layouts: customer (key;name;nation;acctbal;segment), supplier (key;nation;name;supplier_flag;acctbal —
    other order, one extra column) and nation (key;name), whose lines have one, two or four fields."""
    root = scratch_path(spark, "union_csv")
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("name"),
        F.col("c_nationkey").cast("string").alias("nation"),
        F.col("c_acctbal").cast("string").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("key"), F.col("s_nationkey").cast("string").alias("nation"),
        F.col("s_name").alias("name"), F.lit("Y").alias("supplier_flag"),
        F.col("s_acctbal").cast("string").alias("acctbal"))
    write_delimited(c, f"{root}/customer", sep=";")
    write_delimited(s, f"{root}/supplier", sep=";")
    key, odd = F.concat(F.lit("n"), F.col("n_nationkey").cast("string")), F.pmod("n_nationkey", F.lit(3))
    n = table(spark, sf, "nation").select(F.when(odd == 0, key).when(odd == 1, F.concat_ws(";", key, "n_name")).otherwise(
        F.concat_ws(";", key, "n_name", F.lit('"a;""b"'), "n_regionkey")).alias("key;name"))
    n.write.option("header", True).option("sep", "\u0001\u0002").option("quote", "\u0000").option("escapeQuotes", False).csv(f"{root}/nation")
    out = read_delimited_union(spark, [f"{root}/{x}" for x in ("customer", "supplier", "nation")], sep=";", key_col="key", rescued="_rescued")
    return out.select("key", "name", "nation", "acctbal", "segment", "supplier_flag",
                      *[F.try_element_at("_rescued", F.lit(f"_c{i}")).alias(c) for i, c in ((2, "third"), (3, "fourth"))])


LATIN_SAFE = r"^[\x00-\x7F\xA0-\xFF]*$"


@query("read_charset_csv", r"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text
FROM documents
WHERE regexp_matches(text, '^[\x00-\x7F\xA0-\xFF]*$')""")
def q_read_charset_csv(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents").where(F.col("text").rlike(LATIN_SAFE))
    path = scratch_path(spark, "cp1252_csv")
    write_delimited(d.select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "text"), path, sep=";",
                    encoding="windows-1252")
    return read_charset_csv(spark, path, sep=";", encoding="windows-1252", multi_line=True)  # texts hold line breaks


@query("read_json_strings", """
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, props,
       json_extract_string(props, '$.k') AS k
FROM events""")
def q_read_json_strings(spark: SparkSession, sf: str):
    e = table(spark, sf, "events")
    path = scratch_path(spark, "events_ndjson")
    line = F.concat(F.expr("substring(to_json(named_struct('event_id', event_id, 'event_type', event_type)), "
                           "1, length(to_json(named_struct('event_id', event_id, 'event_type', event_type))) - 1)"),
                    F.lit(',"props":'), F.col("props"), F.lit("}"))
    e.select(line.alias("value")).write.mode("overwrite").text(path)
    j = read_json_strings(spark, path, multi_line=False)
    return j.select("event_id", "event_type", "props", F.get_json_object("props", "$.k").alias("k"))


@query("read_parquet_typed", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate::VARCHAR AS l_shipdate
FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 10""")
def q_read_parquet_typed(spark: SparkSession, sf: str):
    df = read_parquet_typed(spark, f"{sf}/lineitem.parquet",
                            ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"],
                            (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 10))
    return df.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("list_files", """
SELECT 'source=' || source AS folder, count(DISTINCT doc_id % 5) AS n_files, CAST(sum(strlen(lang || doc_id) + 1) AS BIGINT) AS bytes,
       true AS recent
FROM documents WHERE doc_id % 5 <> 3 GROUP BY source""")
def q_list_files(spark: SparkSession, sf: str):
    """Documents' languages and ids landed as text files, one per source and remainder of the id, in two levels of folders (plus
    files that the glob leaves out); the listing gives their number, size and time."""
    d = table(spark, sf, "documents")
    root = scratch_path(spark, "landing_tree")
    lines = d.select(F.concat("lang", F.col("doc_id").cast("string")).alias("value"), "source", F.pmod("doc_id", F.lit(5)).alias("rest"))
    for other, fmt in ((False, "text"), (True, "json")):
        part = lines.where((F.col("rest") == 3) == F.lit(other)).repartition("source", "rest")
        part.write.mode("append").partitionBy("source", "rest").format(fmt).save(root)
    files = list_files(spark, root, "*.t[x]t")
    recent = F.col("modified") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return (files.groupBy(F.regexp_extract("path", r"/(source=[^/]+)/rest=\d/[^/]+$", 1).alias("folder"))
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"), F.min(recent).alias("recent")))


@query("with_lineage", """
SELECT 'event_type=' || event_type AS folder, count(*) AS n_rows, min(event_id) AS first_id
FROM events GROUP BY event_type""")
def q_with_lineage(spark: SparkSession, sf: str):
    e = table(spark, sf, "events")
    root = scratch_path(spark, "events_by_type")
    e.write.mode("overwrite").partitionBy("event_type").parquet(root)
    df = with_lineage(spark.read.parquet(root))
    folder = F.regexp_extract("_source_file", r"/(event_type=[^/]+)/[^/]+$", 1)
    return df.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_rows"),
                                                  F.min("event_id").alias("first_id"))


@query("read_existing", "SELECT * FROM customer")
def q_read_existing(spark: SparkSession, sf: str):
    table(spark, sf, "customer").createOrReplaceTempView("alpina_customer_view")
    df = read_existing(spark, ["alpina_customer_view", "alpina_table_that_does_not_exist"])
    return df


@query("raster_to_pixels", """
SELECT vec_id AS tile_id, CAST((i - 1) // 8 AS INTEGER) AS "row", CAST((i - 1) % 8 AS INTEGER) AS col,
       round(CAST(embedding[i] AS DOUBLE), 6) AS z
FROM embeddings, range(1, 65) t(i)""")
def q_raster_to_pixels(spark: SparkSession, sf: str):
    emb = table(spark, sf, "embeddings")
    tiles = emb.select(F.col("vec_id").alias("tile_id"),
                       F.transform(F.sequence(F.lit(0), F.lit(7)),
                                   lambda i: F.transform(F.slice("embedding", i * 8 + 1, 8),
                                                         lambda x: x.cast("double"))).alias("z"))
    px = raster_to_pixels(tiles, "z", ("tile_id",))
    return px.select("tile_id", "row", "col", r6("z").alias("z"))


@query("extract_links", r"""
WITH h AS (
  SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || '/' AS base,
         unnest(regexp_extract_all(html, '(?i)href="([^"]+)"', 1)) AS href
  FROM pages),
r AS (
  SELECT page_id, base, regexp_extract(base, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href AS link
  FROM h WHERE starts_with(href, '/') AND NOT starts_with(href, '//'))
SELECT DISTINCT page_id, link FROM r WHERE regexp_extract(link, '^(.*/)[^/]*$', 1) = base""")
def q_extract_links(spark: SparkSession, sf: str):
    p = table(spark, sf, "pages")
    p = p.withColumn("base", F.concat(F.regexp_extract("url", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.lit("/")))
    return extract_links(p, "html", "base", ext=None, key_cols=("page_id",))


ASSET_KEY = "lower(replace(p_name, ' ', '_')) || '_' || CAST(p_partkey AS VARCHAR) || '.csv'"


@query("catalog_assets", f"""
SELECT CAST(p_partkey // 10 AS VARCHAR) AS folder, {ASSET_KEY} AS "key",
       'https://data.example/' || CAST(p_partkey // 10 AS VARCHAR) || '/' || {ASSET_KEY} AS href,
       CASE WHEN p_size % 3 = 0 THEN NULL ELSE '1220' || sha256(p_name) END AS checksum,
       p_brand AS updated
FROM part""")
def q_catalog_assets(spark: SparkSession, sf: str):
    """Catalog items of ten parts each, serialised to item JSON, then parsed back to assets."""
    p = table(spark, sf, "part")
    key = F.expr(ASSET_KEY.replace("CAST(p_partkey AS VARCHAR)", "CAST(p_partkey AS STRING)"))
    item = (F.col("p_partkey") / 10).cast("long").cast("string")
    assets = p.select(item.alias("item"), key.alias("k"), F.struct(
        F.concat(F.lit("https://data.example/"), item, F.lit("/"), key).alias("href"),
        F.when(F.pmod("p_size", F.lit(3)) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("1220"), F.sha2("p_name", 256))).alias("file:checksum"),
        F.col("p_brand").alias("updated")).alias("v"))
    items = assets.groupBy("item").agg(
        F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("assets"))).alias("json"))
    return catalog_assets(items, "json", "item").select("folder", "key", "href", "checksum", "updated")


@query("item_ids", """
SELECT lower(replace(s_name, '#', '-')) AS item_id FROM supplier""")
def q_item_ids(spark: SparkSession, sf: str):
    """Collection pages of ten suppliers each, with next links, parsed back to item ids."""
    s = table(spark, sf, "supplier")
    page = (F.col("s_suppkey") / 10).cast("long")
    pages = s.groupBy(page.alias("page")).agg(
        F.collect_list(F.struct(F.lower(F.regexp_replace("s_name", "#", "-")).alias("id"))).alias("features"))
    pages = pages.select(F.to_json(F.struct(
        "features",
        F.array(F.struct(F.lit("next").alias("rel"),
                         F.concat(F.lit("https://data.example/items?page="), (F.col("page") + 1).cast("string"))
                         .alias("href"))).alias("links"))).alias("json"))
    return item_ids(pages, "json")


@query("parse_url_list", """
SELECT arg_min(page_id, page_id) AS ordinal, arg_min(url, page_id) AS url, name
FROM (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS name FROM pages
      WHERE starts_with(url, 'http') AND regexp_extract(url, '([^/]*)$', 1) <> '')
GROUP BY name""")
def q_parse_url_list(spark: SparkSession, sf: str):
    p = table(spark, sf, "pages")
    lines = p.select("page_id", F.when(F.pmod("page_id", F.lit(3)) == 0,
                                       F.concat(F.lit(' "'), F.col("url"), F.lit('" ')))
                     .otherwise(F.col("url")).alias("line"))
    return parse_url_list(lines, "line", "page_id", name_pattern=r".+").select("ordinal", "url", "name")


@query("to_json_lines", """
SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":'
       || n_regionkey || '}' AS json
FROM nation""")
def q_to_json_lines(spark: SparkSession, sf: str):
    n = table(spark, sf, "nation")
    path = scratch_path(spark, "nation_ndjson")
    to_json_lines(n).write.mode("overwrite").text(path)
    back = spark.read.text(path).select(F.col("value").alias("json"))
    return back.select(F.get_json_object("json", "$.n_nationkey").cast("int").alias("n_nationkey"), "json")
