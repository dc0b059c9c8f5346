"""Queries for projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.functions.casts import cast_double_strict, cast_double_try, nan_to_null
from alpina.functions.checks import sniff_magic, verify_checksum
from alpina.functions.geo import grid_cell
from alpina.functions.names import clean_columns
from alpina.functions.text import normalize_key, parse_asset_name, parse_tile_name
from alpina.functions.timeparse import parse_http_date, parse_ts_multi, parse_ts_strict
from alpina.operators.projection import (
    bbox_filter, drop_null_keys, project_dynamic, project_values, select_assets,
    station_snapshot_project,
)
from alpina.operators.quality import expect_or_drop
from alpina.plans.registry import query, r6, table, ts_text, ts_text_ms


@query("clean_columns", """
SELECT c_custkey AS c_custkey, c_name AS c_name, c_nationkey AS c_nationkey,
       c_acctbal AS c_acctbal__eur_, c_mktsegment AS _unnamed
FROM customer""")
def q_clean_columns(spark: SparkSession, sf: str):
    c = table(spark, sf, "customer")
    messy = c.toDF(" C_CustKey ", "c_name", "C_NATIONKEY", "c-acctbal (EUR)", "  ")
    return clean_columns(messy)


@query("normalize_key", """
SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS key_trim, upper('  ' || p_name || ' ') AS key_upper
FROM part""")
def q_normalize_key(spark: SparkSession, sf: str):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("raw"))
    return p.select("p_partkey", normalize_key("raw").alias("key_trim"),
                    normalize_key("raw", trim=False).alias("key_upper"))


@query("parse_ts_strict", """
SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y %H:%M') AS raw,
       strftime(strptime(strftime(o_orderdate, '%d.%m.%Y %H:%M'), '%d.%m.%Y %H:%M'), '%Y-%m-%d %H:%M:%S') AS ts
FROM orders""")
def q_parse_ts_strict(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy HH:mm").alias("raw"))
    return o.select("o_orderkey", "raw", ts_text(parse_ts_strict("raw")).alias("ts"))


# Six renderings of the order date by key % 6; the last one is not an accepted form.
_RENDER_SPARK = [
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'.123Z'",
    "yyyy-MM-dd HH:mm:ss'+02:00'",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "dd.MM.yyyy HH:mm",
]


@query("parse_ts_multi", """
SELECT o_orderkey,
  CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.123Z')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S+02:00')
    WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%d')
    ELSE strftime(o_orderdate, '%d.%m.%Y %H:%M') END AS raw,
  CASE o_orderkey % 6
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000')
    WHEN 1 THEN strftime(o_orderdate + INTERVAL 123 MILLISECOND, '%Y-%m-%d %H:%M:%S.%g')
    WHEN 2 THEN strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S.000')
    WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.000')
    WHEN 4 THEN strftime(date_trunc('day', o_orderdate), '%Y-%m-%d %H:%M:%S.000')
    ELSE NULL END AS ts
FROM orders""")
def q_parse_ts_multi(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders")
    k = F.pmod("o_orderkey", F.lit(6))
    raw = F.lit(None).cast("string")
    for i, fmt in reversed(list(enumerate(_RENDER_SPARK))):
        raw = F.when(k == i, F.date_format("o_orderdate", fmt)).otherwise(raw)
    o = o.select("o_orderkey", raw.alias("raw"))
    return o.select("o_orderkey", "raw", ts_text_ms(parse_ts_multi("raw")).alias("ts"))


@query("cast_double_strict", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_tax AS VARCHAR) AS raw,
       round(CAST(CAST(l_tax AS VARCHAR) AS DOUBLE), 6) AS l_tax
FROM lineitem""")
def q_cast_double_strict(spark: SparkSession, sf: str):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                             F.col("l_tax").cast("string").alias("raw"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "raw",
                     r6(cast_double_strict("raw")).alias("l_tax"))


@query("cast_double_try", """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS raw,
       TRY_CAST(CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS DOUBLE) AS v
FROM part""")
def q_cast_double_try(spark: SparkSession, sf: str):
    p = table(spark, sf, "part")
    raw = F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.col("p_name")).otherwise(F.col("p_size").cast("string"))
    p = p.select("p_partkey", raw.alias("raw"))
    return p.select("p_partkey", "raw", cast_double_try("raw").alias("v"))


@query("project_values", """
SELECT s_suppkey, round(s_acctbal, 6) AS s_acctbal, CAST(s_nationkey AS DOUBLE) AS s_nationkey,
       NULL::DOUBLE AS s_missing, s_name
FROM supplier""")
def q_project_values(spark: SparkSession, sf: str):
    s = table(spark, sf, "supplier")
    out = project_values(s, ["s_suppkey"], ["s_acctbal", "s_nationkey", "s_missing"], extra=["s_name"])
    return out.withColumn("s_acctbal", r6("s_acctbal"))


@query("project_dynamic", """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus,
       CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey,
       round(l_quantity, 6) AS l_quantity, round(l_extendedprice, 6) AS l_extendedprice,
       round(l_discount, 6) AS l_discount, round(l_tax, 6) AS l_tax
FROM lineitem""")
def q_project_dynamic(spark: SparkSession, sf: str):
    li = table(spark, sf, "lineitem").drop("l_shipdate")
    tech = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    text = li.select(*[F.col(c) if c in tech else F.col(c).cast("string").alias(c) for c in li.columns])
    out = project_dynamic(text, tech, lead=[F.col(c) for c in tech])
    return out.select(*tech, *[r6(c).alias(c) for c in out.columns if c not in tech])


@query("drop_null_keys", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""")
def q_drop_null_keys(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders")
    o = o.select(F.when(F.pmod("o_orderkey", F.lit(7)) != 0, F.col("o_orderkey")).alias("k1"),
                 F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.col("o_custkey")).alias("k2"),
                 "o_orderkey", "o_custkey", "o_orderstatus")
    return drop_null_keys(o, ["k1", "k2"]).select("o_orderkey", "o_custkey", "o_orderstatus")


EVENT_EXPECTATIONS = {"value_below_400": "value < 400", "known_type": "event_type IN ('click', 'view', 'purchase', 'error')"}


@query("expect_or_drop", """
SELECT event_id, user_id, event_type, round(value, 6) AS value FROM events
WHERE value < 400 AND event_type IN ('click', 'view', 'purchase', 'error')""")
def q_expect_or_drop(spark: SparkSession, sf: str):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    kept, _obs = expect_or_drop(e, EVENT_EXPECTATIONS)
    return kept.withColumn("value", r6("value"))


# Asset names synthesised from supplier: station s<key>, granularity by key % 5, period by
# key % 4 (3 = none), decade years by key % 3 (0 = none); every eleventh name is unparsable.
def _asset_names(spark, sf):
    s = table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    gran = F.element_at(F.array(*[F.lit(x) for x in "tdhmy"]), (F.pmod(k, F.lit(5)) + 1).cast("int"))
    period = F.element_at(F.array(F.lit("_historical"), F.lit("_recent"), F.lit("_now"), F.lit("")),
                          (F.pmod(k, F.lit(4)) + 1).cast("int"))
    y0 = (F.lit(1960) + F.pmod(k, F.lit(7)) * 10)
    years = F.when(F.pmod(k, F.lit(3)) == 0, F.lit("")).otherwise(
        F.concat(F.lit("_"), y0.cast("string"), F.lit("-"), (y0 + 9).cast("string")))
    name = F.when(F.pmod(k, F.lit(11)) == 0, F.concat(F.lit("readme_"), k.cast("string"), F.lit(".txt"))) \
        .otherwise(F.concat(F.lit("ogd-smn_s"), k.cast("string"), F.lit("_"), gran, period, years, F.lit(".csv")))
    return s.select("s_suppkey", name.alias("name"))


ASSET_EXPECTED_SQL = """
SELECT s_suppkey,
  CASE WHEN s_suppkey % 11 = 0 THEN 'readme_' || s_suppkey || '.txt'
       ELSE 'ogd-smn_s' || s_suppkey || '_' || ['t','d','h','m','y'][s_suppkey % 5 + 1]
            || ['_historical','_recent','_now',''][s_suppkey % 4 + 1]
            || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '_' || (1960 + (s_suppkey % 7) * 10) || '-' || (1969 + (s_suppkey % 7) * 10) END
            || '.csv' END AS name,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE 's' || s_suppkey END AS station,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE ['t','d','h','m','y'][s_suppkey % 5 + 1] END AS gran,
  CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 4 = 3 THEN NULL ELSE ['historical','recent','now'][s_suppkey % 4 + 1] END AS period,
  CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 3 = 0 THEN NULL ELSE CAST(1960 + (s_suppkey % 7) * 10 AS INTEGER) END AS start_year,
  CASE WHEN s_suppkey % 11 = 0 OR s_suppkey % 3 = 0 THEN NULL ELSE CAST(1969 + (s_suppkey % 7) * 10 AS INTEGER) END AS end_year
FROM supplier"""


@query("parse_asset_name", ASSET_EXPECTED_SQL)
def q_parse_asset_name(spark: SparkSession, sf: str):
    n = _asset_names(spark, sf).select("s_suppkey", "name", parse_asset_name("name").alias("a"))
    return n.select("s_suppkey", "name", "a.station", "a.gran", "a.period", "a.start_year", "a.end_year")


@query("select_assets", f"""
SELECT name, station, gran, period, end_year FROM ({ASSET_EXPECTED_SQL})
WHERE gran IN ('h', 'd', 'm') AND (period IS NULL OR period IN ('historical', 'recent'))
  AND (end_year IS NULL OR end_year >= 1990)""")
def q_select_assets(spark: SparkSession, sf: str):
    n = _asset_names(spark, sf).select("name", parse_asset_name("name").alias("a"))
    parsed = n.where(F.col("a").isNotNull()).select("name", "a.*")
    return select_assets(parsed, ["h", "d", "m"], ["historical", "recent"], 1990) \
        .select("name", "station", "gran", "period", "end_year")


# Tile names synthesised from part: year 2017+key%5, E km 2480+key%100, N km 1070+(key/100)%100.
def _tile_urls(spark, sf):
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    e = (F.lit(2480) + F.pmod(k, F.lit(100))).cast("string")
    n = (F.lit(1070) + F.pmod((k / 100).cast("long"), F.lit(100))).cast("string")
    res = F.when(F.pmod(k, F.lit(2)) == 0, F.lit("2")).otherwise(F.lit("0.5"))
    name = F.concat(F.lit("swissalti3d_"), (F.lit(2017) + F.pmod(k, F.lit(5))).cast("string"), F.lit("_"),
                    e, F.lit("-"), n, F.lit("_"), res, F.lit("_2056_5728.tif"))
    url = F.when(F.pmod(k, F.lit(13)) == 0, F.concat(F.lit("https://data.example/x/"), k.cast("string"), F.lit(".zip"))) \
        .otherwise(F.concat(F.lit("https://data.example/alti/"), name))
    return p.select("p_partkey", url.alias("url"))


TILE_EXPECTED_SQL = """
SELECT p_partkey,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE 'swissalti3d_' || (2017 + p_partkey % 5) || '_' || (2480 + p_partkey % 100)
       || '-' || (1070 + (p_partkey // 100) % 100) || '_' || CASE WHEN p_partkey % 2 = 0 THEN '2' ELSE '0.5' END
       || '_2056_5728.tif' END AS name,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(2017 + p_partkey % 5 AS INTEGER) END AS "year",
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(2480 + p_partkey % 100 AS INTEGER) END AS e_km,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(1070 + (p_partkey // 100) % 100 AS INTEGER) END AS n_km,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 2 = 0 THEN '2' ELSE '0.5' END AS resolution,
  CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE (2480 + p_partkey % 100) || '-' || (1070 + (p_partkey // 100) % 100) END AS tile_id
FROM part"""


@query("parse_tile_name", TILE_EXPECTED_SQL)
def q_parse_tile_name(spark: SparkSession, sf: str):
    t = _tile_urls(spark, sf).select("p_partkey", parse_tile_name("url").alias("t"))
    return t.select("p_partkey", "t.name", "t.year", "t.e_km", "t.n_km", "t.resolution", "t.tile_id")


@query("bbox_filter", f"""
SELECT p_partkey, name, e_km, n_km FROM ({TILE_EXPECTED_SQL})
WHERE name IS NOT NULL AND e_km BETWEEN 2490 AND 2540 AND n_km BETWEEN 1075 AND 1120""")
def q_bbox_filter(spark: SparkSession, sf: str):
    t = _tile_urls(spark, sf).select("p_partkey", parse_tile_name("url").alias("t"))
    t = t.where(F.col("t").isNotNull()).select("p_partkey", "t.name", "t.e_km", "t.n_km")
    return bbox_filter(t, (2490, 1075, 2540, 1120))


@query("verify_checksum", """
SELECT doc_id, CASE WHEN doc_id % 13 = 0 OR doc_id % 17 = 0 THEN NULL
                    WHEN doc_id % 9 = 0 OR doc_id % 11 = 0 THEN false ELSE true END AS ok
FROM documents""")
def q_verify_checksum(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents")
    k = F.col("doc_id")
    digest = F.sha2("text", 256)
    ck = (F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None).cast("string"))
          .when(F.pmod(k, F.lit(17)) == 0, F.concat(F.lit("1b20"), digest))
          .when(F.pmod(k, F.lit(9)) == 0, F.concat(F.lit("1220"), F.sha2(F.concat("text", F.lit("x")), 256)))
          .when(F.pmod(k, F.lit(11)) == 0, F.concat(F.lit("1220"), F.upper(digest)))
          .otherwise(F.concat(F.lit("1220"), digest)))
    return d.select("doc_id", verify_checksum("text", ck).alias("ok"))


@query("sniff_magic", """
SELECT page_id, page_id % 5 < 4 AS is_tiff FROM pages""")
def q_sniff_magic(spark: SparkSession, sf: str):
    p = table(spark, sf, "pages")
    m = F.pmod("page_id", F.lit(5))
    prefix = (F.when(m == 0, F.lit("49492A00")).when(m == 1, F.lit("4D4D002A"))
              .when(m == 2, F.lit("49492B00")).when(m == 3, F.lit("4D4D002B")).otherwise(F.lit("3C21444F")))
    content = F.concat(F.unhex(prefix), F.encode("html", "UTF-8"))
    return p.select("page_id", sniff_magic(content).alias("is_tiff"))


@query("parse_http_date", """
SELECT o_orderkey, strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT') AS raw,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts
FROM orders""")
def q_parse_http_date(spark: SparkSession, sf: str):
    o = table(spark, sf, "orders")
    raw = F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    o = o.select("o_orderkey", raw.alias("raw"))
    return o.select("o_orderkey", "raw", ts_text(parse_http_date("raw")).alias("ts"))


@query("grid_cell", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(floor(l_extendedprice / 50) * 50 AS BIGINT) AS cell_e,
       CAST(floor(l_quantity * 1000 / 50) * 50 AS BIGINT) AS cell_n,
       CAST(floor(l_extendedprice / 50) * 50 AS BIGINT) + CAST(25 AS DOUBLE) AS center_e,
       CAST(floor(l_quantity * 1000 / 50) * 50 AS BIGINT) + CAST(25 AS DOUBLE) AS center_n,
       'E' || CAST(floor(l_extendedprice / 50) * 50 AS BIGINT) || '_N' || CAST(floor(l_quantity * 1000 / 50) * 50 AS BIGINT) AS cell_id
FROM lineitem""")
def q_grid_cell(spark: SparkSession, sf: str):
    li = table(spark, sf, "lineitem")
    g = grid_cell(F.col("l_extendedprice"), F.col("l_quantity") * 1000, 50)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[c.alias(n) for n, c in g.items()])


@query("nan_to_null", """
SELECT vec_id, i - 1 AS pos,
       CASE WHEN (vec_id * 64 + i - 1) % 7 = 0 THEN NULL ELSE round(CAST(embedding[i] AS DOUBLE), 6) END AS z
FROM embeddings, range(1, 65) t(i)""")
def q_nan_to_null(spark: SparkSession, sf: str):
    emb = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v"))
    z = F.when(F.pmod(F.col("vec_id") * 64 + F.col("pos"), F.lit(7)) == 0, F.lit(float("nan"))) \
        .otherwise(F.col("v").cast("double"))
    out = nan_to_null(emb.select("vec_id", F.col("pos").cast("long").alias("pos"), z.alias("z")))
    return out.withColumn("z", r6("z"))


@query("station_snapshot_project", """
SELECT upper(lower(s_name)) AS station_code, 'Station ' || s_suppkey AS label,
       round(s_acctbal, 6) AS lon, CAST(s_nationkey AS DOUBLE) AS lat,
       CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(1000 + s_suppkey AS DOUBLE) END AS elevation,
       'CH' AS country_code, CAST(s_nationkey AS VARCHAR) AS canton_code, 'SNOW_FLAT' AS "type",
       '2024-01-01 06:00:00' AS _snapshot_at
FROM supplier""")
def q_station_snapshot_project(spark: SparkSession, sf: str):
    s = table(spark, sf, "supplier")
    raw = s.select(F.lower("s_name").alias("code"), F.concat(F.lit("Station "), F.col("s_suppkey").cast("string")).alias("label"),
                   F.col("s_acctbal").cast("string").alias("lon"), F.col("s_nationkey").cast("string").alias("lat"),
                   F.when(F.pmod("s_suppkey", F.lit(4)) == 0, F.lit("n/a"))
                    .otherwise((F.col("s_suppkey") + 1000).cast("string")).alias("elevation"),
                   F.lit("CH").alias("country_code"), F.col("s_nationkey").cast("string").alias("canton_code"),
                   F.lit("SNOW_FLAT").alias("type"),
                   F.to_timestamp(F.lit("2024-01-01 06:00:00")).alias("_ingested_at"))
    out = station_snapshot_project(raw)
    return out.withColumn("lon", r6("lon")).withColumn("_snapshot_at", ts_text("_snapshot_at"))
