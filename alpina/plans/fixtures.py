"""Fixtures derived by Spark from the provided tables (they grow with the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.plans.registry import table

# Events raster: 500 events per tile, 20 rows × 25 columns, z = value / 10, 2 m pixels.
RASTER_RES = 2.0
RASTER_CELL = 10          # 10 m cells → 5 × 5 pixel blocks
RASTER_W = 25
RASTER_PER_TILE = 500
RASTER_E0 = 2600000.0     # west edge of tile 0; tile t starts at E0 + 50·t
RASTER_N_TOP = 1200000.0  # north edge of every tile


def events_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    tile = F.floor(F.col("event_id") / RASTER_PER_TILE).cast("long")
    return e.select(
        tile.alias("tile_id"),
        F.floor(F.pmod("event_id", F.lit(RASTER_PER_TILE)) / RASTER_W).cast("int").alias("row"),
        F.pmod("event_id", F.lit(RASTER_W)).cast("int").alias("col"),
        (F.col("value") / 10.0).alias("z"),
        (F.lit(RASTER_E0) + tile * (RASTER_W * RASTER_RES)).alias("e_min"),
        F.lit(RASTER_N_TOP).alias("n_max"),
    )


def events_tile_corners():
    """(west, north) edges of an events-raster tile as expressions of ``tile_id``."""
    return (F.lit(RASTER_E0) + F.col("tile_id") * (RASTER_W * RASTER_RES), F.lit(RASTER_N_TOP))


def events_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per events-raster tile with its west / north edge (derived from the tile id)."""
    e = table(spark, sf_dir, "events")
    tile = F.floor(F.col("event_id") / RASTER_PER_TILE).cast("long")
    t = e.select(tile.alias("tile_id")).distinct()
    return t.select("tile_id", (F.lit(RASTER_E0) + F.col("tile_id") * (RASTER_W * RASTER_RES)).alias("e_min"),
                    F.lit(RASTER_N_TOP).alias("n_max"))


# SQL twin of events_pixels for the oracles.
EVENTS_PIXELS_SQL = """
px AS (
  SELECT event_id // 500 AS tile_id, (event_id % 500) // 25 AS "row", event_id % 25 AS col,
         value / CAST(10 AS DOUBLE) AS z, CAST(2600000 AS DOUBLE) + CAST((event_id // 500) * 50 AS DOUBLE) AS e_min,
         CAST(1200000 AS DOUBLE) AS n_max
  FROM events)"""

# Gradient + slope/aspect in SQL (numpy.gradient: central inside, one-sided at edges).
EVENTS_SLOPE_SQL = EVENTS_PIXELS_SQL + """,
g AS (
  SELECT *,
    CASE WHEN lag(col) OVER wr IS NULL THEN (lead(z) OVER wr - z) / CAST(2 AS DOUBLE)
         WHEN lead(col) OVER wr IS NULL THEN (z - lag(z) OVER wr) / CAST(2 AS DOUBLE)
         ELSE (lead(z) OVER wr - lag(z) OVER wr) / CAST(4 AS DOUBLE) END AS dz_de,
    -(CASE WHEN lag("row") OVER wc IS NULL THEN (lead(z) OVER wc - z) / CAST(2 AS DOUBLE)
           WHEN lead("row") OVER wc IS NULL THEN (z - lag(z) OVER wc) / CAST(2 AS DOUBLE)
           ELSE (lead(z) OVER wc - lag(z) OVER wc) / CAST(4 AS DOUBLE) END) AS dz_dn
  FROM px
  WINDOW wr AS (PARTITION BY tile_id, "row" ORDER BY col),
         wc AS (PARTITION BY tile_id, col ORDER BY "row")),
s AS (
  SELECT *, degrees(atan(sqrt(dz_de * dz_de + dz_dn * dz_dn))) AS slope,
         ((degrees(atan2(-dz_de, -dz_dn)) % CAST(360 AS DOUBLE)) + CAST(360 AS DOUBLE)) % CAST(360 AS DOUBLE) AS aspect
  FROM g),
sa AS (
  SELECT *, CASE WHEN slope >= CAST(1 AS DOUBLE) THEN cos(radians(aspect)) END AS cos_a,
            CASE WHEN slope >= CAST(1 AS DOUBLE) THEN sin(radians(aspect)) END AS sin_a
  FROM s)"""


def orders_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a file listing: id, name, modification time (ISO text and timestamp), size."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.concat(F.lit("f"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("file_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modified_time"),
        F.col("o_orderdate").cast("timestamp").alias("modified_at"),
        F.floor("o_totalprice").cast("long").alias("size"),
    )


def orders_ledger(spark: SparkSession, sf_dir: str, target: str = "bronze_orders") -> DataFrame:
    """Ledger = orders with status F; every third key logged one day earlier."""
    o = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F")
    mod = F.when(F.pmod("o_orderkey", F.lit(3)) == 0, F.col("o_orderdate") - F.expr("INTERVAL 1 DAY")) \
        .otherwise(F.col("o_orderdate"))
    return o.select(
        F.col("o_orderkey").cast("string").alias("file_id"),
        F.date_format(mod, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("modified_time"),
        F.lit(target).alias("target_table"),
    )


LISTING_SQL = """
listing AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id, 'f' || CAST(o_orderkey AS VARCHAR) || '.csv' AS file_name,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS modified_time, CAST(floor(o_totalprice) AS BIGINT) AS size
  FROM orders),
ledger AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS file_id,
         strftime(CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - INTERVAL 1 DAY ELSE o_orderdate END,
                  '%Y-%m-%dT%H:%M:%SZ') AS modified_time
  FROM orders WHERE o_orderstatus = 'F')"""
