"""Queries for latest-per-key, raster gradients, budget prefix, ordering and unions
(SURVEY §2.6–2.8)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.functions.text import parse_tile_name
from alpina.operators.budget import budget_prefix
from alpina.operators.dedupe import latest_per_key, latest_snapshot
from alpina.operators.projection import preview, sorted_limit, union_by_name
from alpina.operators.terrain import grid_gradient, with_slope_aspect
from alpina.plans.fixtures import EVENTS_SLOPE_SQL, RASTER_RES, events_pixels
from alpina.plans.q_columns import TILE_EXPECTED_SQL, _tile_urls
from alpina.plans.registry import query, r6, table, ts_text_ms


@query("latest_per_key", """
SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts, round(value, 6) AS value
FROM events
WHERE user_id IS NOT NULL AND event_type IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_per_key(spark: SparkSession, sf: str):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    out = latest_per_key(e, ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id", ts_text_ms("ts").alias("ts"), r6("value").alias("value"))


@query("latest_snapshot", """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def q_latest_snapshot(spark: SparkSession, sf: str):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    out = latest_snapshot(e, ["user_id"], ["ts", "event_id"])
    return out.select("user_id", "event_id", "event_type", ts_text_ms("ts").alias("ts"))


@query("grid_gradient", f"""
WITH {EVENTS_SLOPE_SQL}
SELECT tile_id, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col,
       round(dz_de, 6) AS dz_de, round(dz_dn, 6) AS dz_dn FROM g""")
def q_grid_gradient(spark: SparkSession, sf: str):
    g = grid_gradient(events_pixels(spark, sf), RASTER_RES)
    return g.select("tile_id", "row", "col", r6("dz_de").alias("dz_de"), r6("dz_dn").alias("dz_dn"))


@query("slope_aspect", f"""
WITH {EVENTS_SLOPE_SQL}
SELECT tile_id, CAST("row" AS INTEGER) AS "row", CAST(col AS INTEGER) AS col,
       round(slope, 6) AS slope, round(aspect, 6) AS aspect,
       round(cos_a, 6) AS cos_a, round(sin_a, 6) AS sin_a FROM sa""")
def q_slope_aspect(spark: SparkSession, sf: str):
    s = with_slope_aspect(grid_gradient(events_pixels(spark, sf), RASTER_RES))
    return s.select("tile_id", "row", "col", *[r6(c).alias(c) for c in ("slope", "aspect", "cos_a", "sin_a")])


BUDGET, RESERVE = 2_000_000, 500_000


@query("budget_prefix", f"""
SELECT doc_id, n_chars, running_bytes FROM (
  SELECT doc_id, n_chars, CAST(sum(n_chars) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_bytes
  FROM documents)
WHERE running_bytes <= {BUDGET - RESERVE}""")
def q_budget_prefix(spark: SparkSession, sf: str):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    out = budget_prefix(d, "n_chars", ["doc_id"], budget=BUDGET, reserve=RESERVE)
    return out.select("doc_id", "n_chars", F.col("running_bytes").cast("long").alias("running_bytes"))


@query("sorted_limit", f"""
SELECT name, e_km, n_km FROM ({TILE_EXPECTED_SQL}) WHERE name IS NOT NULL
ORDER BY e_km, n_km, name LIMIT 100""")
def q_sorted_limit(spark: SparkSession, sf: str):
    t = _tile_urls(spark, sf).select(parse_tile_name("url").alias("t")).where(F.col("t").isNotNull())
    return sorted_limit(t.select("t.name", "t.e_km", "t.n_km"), ["e_km", "n_km", "name"], 100)


@query("preview", """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 20""")
def q_preview(spark: SparkSession, sf: str):
    return preview(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey"])


@query("union_by_name", """
SELECT c_custkey AS "key", c_name AS name, c_nationkey AS nationkey, round(c_acctbal, 6) AS acctbal, 'customer' AS kind
FROM customer
UNION ALL
SELECT s_suppkey, s_name, s_nationkey, round(s_acctbal, 6), 'supplier' FROM supplier""")
def q_union_by_name(spark: SparkSession, sf: str):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("key"),
                                            r6("c_acctbal").alias("acctbal"), F.col("c_nationkey").alias("nationkey"),
                                            F.lit("customer").alias("kind"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nationkey"),
                                            F.col("s_name").alias("name"), r6("s_acctbal").alias("acctbal"),
                                            F.lit("supplier").alias("kind"))
    return union_by_name([c, s])
