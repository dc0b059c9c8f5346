"""Queries for the composed flows."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from alpina.fixed_values import DAILY_SNOW_COLS, MEAS_COLS, PRECIP_COLS
from alpina.operators.terrain_blocks import BLOCK, cut_blocks, terrain_cells_from_blocks
from alpina.plans.fixtures import RASTER_CELL, RASTER_RES, events_pixels
from alpina.plans.flows import ingest_flow, snow_flow, terrain_flow, weather_flow
from alpina.plans.q_aggregates import CELLS_SQL
from alpina.plans.registry import query, r6, table, ts_text
from alpina.session import scratch_path
from alpina.sinks.keyed import KeyedTable
from alpina.sinks.ledger import ledger_rows, record_ledger
from alpina.sinks.tables import read_replaced
from alpina.sources.delimited import write_delimited
from alpina.sources.files import list_files


@query("weather_silver", """
WITH e AS (
  SELECT 'ST' || (event_id % 7) AS station_abbr, date_trunc('hour', ts) AS t, event_id % 7 AS station, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(length(props) AS DOUBLE) AS vlen, event_type
  FROM events),
g AS (
  SELECT 'hourly' AS granularity, 1 AS delivery, station_abbr, t, value, k, NULL::DOUBLE AS vlen FROM e
  WHERE event_type IN ('click', 'view')
  UNION ALL SELECT 'daily', 1, station_abbr, t, value, k, NULL FROM e
  UNION ALL SELECT 'daily', 2, station_abbr, t, value + 1, k, vlen FROM e WHERE station < 2)
SELECT granularity, station_abbr, strftime(t, '%Y-%m-%d %H:%M:%S') AS reference_ts, round(value, 6) AS value, k, vlen
FROM g
QUALIFY row_number() OVER (PARTITION BY granularity, station_abbr, t
                           ORDER BY delivery DESC, value DESC NULLS LAST, k DESC NULLS LAST, vlen DESC NULLS LAST) = 1""")
def q_weather_silver(spark: SparkSession, sf: str):
    """Two granularities that share keys, many rows per station and instant within a delivery, then a
    re-delivery of two stations with changed values and one more column; one silver per granularity."""
    e = table(spark, sf, "events")
    work = scratch_path(spark, "weather")
    station = F.pmod("event_id", F.lit(7))
    rows = e.select(F.concat(F.lit(" st"), station.cast("string")).alias("station_abbr"),
                    F.date_format(F.date_trunc("hour", "ts"), "dd.MM.yyyy HH:mm").alias("reference_timestamp"),
                    "value", F.get_json_object("props", "$.k").alias("k"), F.length("props").cast("string").alias("vlen"),
                    "event_type", station.alias("station"))
    first, second = ["station_abbr", "reference_timestamp", "value", "k"], ["station_abbr", "value", "k", "vlen", "reference_timestamp"]
    folders = {"hourly": f"{work}/landing/hourly", "daily": f"{work}/landing/daily"}

    def land(df, columns, folder):  # the rows of one key share a file, as in a delivery
        write_delimited(df.withColumn("value", F.col("value").cast("string")).select(*columns)
                        .repartition("station_abbr", "reference_timestamp"), folder, sep=";")

    land(rows.where(F.col("event_type").isin("click", "view")), first, f"{folders['hourly']}/v=1")
    land(rows, first, f"{folders['daily']}/v=1")
    weather_flow(spark, folders, work)
    land(rows.where("station < 2").withColumn("value", F.col("value") + 1), second, f"{folders['daily']}/v=2")
    out = None
    for name, (silver, _) in weather_flow(spark, folders, work).items():
        missing = [F.lit(None).cast("double").alias("vlen")] if "vlen" not in silver.columns else ["vlen"]
        part = silver.select(F.lit(name).alias("granularity"), "station_abbr", ts_text("reference_ts").alias("reference_ts"),
                             r6("value").alias("value"), "k", *missing)
        out = part if out is None else out.unionByName(part)
    return out


@query("snow_silver", """
WITH e AS (
  SELECT upper('stn' || (event_id % 5)) AS station_code, date_trunc('hour', ts) AS t, value, event_id,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events),
s AS (
  SELECT station_code, t, value AS hs, k AS ta_30min_mean, 'history' AS _source_file, 1 AS load FROM e
  UNION ALL SELECT station_code, t, value * 2, NULL, 'live', 2 FROM e WHERE event_id % 4 = 0)
SELECT station_code, strftime(t, '%Y-%m-%d %H:%M:%S') AS measure_date, round(hs, 6) AS hs, ta_30min_mean,
       NULL::DOUBLE AS rh_30min_mean, _source_file
FROM s
QUALIFY row_number() OVER (PARTITION BY station_code, t
                           ORDER BY load DESC, hs DESC NULLS LAST, ta_30min_mean DESC NULLS LAST) = 1""")
def q_snow_silver(spark: SparkSession, sf: str):
    """Archive (all events, many per station and hour) and live (every fourth, later load, other time
    format) bronze tables; precipitation / daily tables absent and skipped."""
    e = table(spark, sf, "events")
    station = F.concat(F.lit("stn"), F.pmod("event_id", F.lit(5)).cast("string"))
    hour = F.date_trunc("hour", "ts")
    hist = e.select(
        station.alias("station_code"), F.date_format(hour, "yyyy-MM-dd HH:mm:ss").alias("measure_date"),
        F.col("value").cast("string").alias("hs"), F.get_json_object("props", "$.k").alias("ta_30min_mean"),
        F.lit("history").alias("_source_file"), F.to_timestamp(F.lit("2024-02-01 00:00:00")).alias("_ingested_at"))
    live = e.where(F.pmod("event_id", F.lit(4)) == 0).select(
        station.alias("station_code"), F.date_format(hour, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("measure_date"),
        (F.col("value") * 2).cast("string").alias("hs"), F.lit("n/a").alias("rh_30min_mean"),
        F.lit("live").alias("_source_file"), F.to_timestamp(F.lit("2024-02-02 00:00:00")).alias("_ingested_at"))
    hist.createOrReplaceTempView("archive_load")
    live.createOrReplaceTempView("live_load")
    root = scratch_path(spark, "snow_silver")
    built = snow_flow(spark, root, {"measured": (["archive_load", "live_load"], MEAS_COLS), "rain": (["archive_rain", "live_rain"], PRECIP_COLS),
                                    "daily": (["archive_daily"], DAILY_SNOW_COLS)}, stations=("places", "live_places"))
    if set(built) != {"measured"}:
        raise RuntimeError(f"built {sorted(built)} from tables that do not exist")
    s = spark.read.parquet(f"{root}/measured")
    return s.select("station_code", ts_text("measure_date").alias("measure_date"), r6("hs").alias("hs"),
                    "ta_30min_mean", "rh_30min_mean", "_source_file")


@query("terrain_flow", f"""
WITH {CELLS_SQL}
SELECT 'tile_' || tile_id AS _source_file_id, 'E' || cell_e || '_N' || cell_n AS cell_id, round(elev_mean, 6) AS elev_mean,
       round(slope_p90, 6) AS slope_p90, round(aspect_mean_deg, 6) AS aspect_mean_deg,
       round(share_slope_30_45, 6) AS share_slope_30_45
FROM cells""")
def q_terrain_flow(spark: SparkSession, sf: str):
    """Tiles assembled as rasters from the events pixels, run through the full chain twice
    (the re-run replaces, not duplicates), read back from the written cell table."""
    px = events_pixels(spark, sf)
    rows = px.groupBy("tile_id", "e_min", "n_max", "row").agg(
        F.array_sort(F.collect_list(F.struct("col", "z"))).alias("cz"))
    tiles = rows.groupBy("tile_id", "e_min", "n_max").agg(
        F.array_sort(F.collect_list(F.struct("row", F.col("cz.z").alias("zr")))).alias("rz"))
    tiles = tiles.select(F.col("tile_id").cast("string").alias("tile_id"), F.lit(2024).alias("year"), "e_min", "n_max",
                         F.floor(F.col("e_min") / 1000).cast("int").alias("tile_e_km"),
                         F.floor(F.col("n_max") / 1000).cast("int").alias("tile_n_km"),
                         F.lit(RASTER_RES).alias("resolution_m"), F.lit("EPSG:2056").alias("crs"),
                         F.concat(F.lit("tile_"), F.col("tile_id").cast("string")).alias("_source_file_id"),
                         F.concat(F.lit("tile_2024_"), F.col("tile_id").cast("string"), F.lit(".tif")).alias("_source_file"),
                         F.to_timestamp(F.lit("2024-05-01 00:00:00")).alias("_source_modified_at"),
                         F.col("rz.zr").alias("z"))
    work = scratch_path(spark, "terrain")
    tiles.write.parquet(f"{work}/_landed_tiles")   # the tile table is an input: land it once
    tiles = spark.read.parquet(f"{work}/_landed_tiles")
    ledger = f"{work}/_ledger"
    terrain_flow(tiles, work, RASTER_CELL, ledger).collect()
    newer = F.when(F.pmod(F.col("tile_id").cast("long"), F.lit(2)) == 0, F.to_timestamp(F.lit("2024-06-01 00:00:00")))
    again = tiles.withColumn("_source_modified_at", F.coalesce(newer, "_source_modified_at"))
    terrain_flow(again, work, RASTER_CELL, ledger).collect()  # every second tile is newer and replaced
    c = read_replaced(spark, f"{work}/terrain_cells", "_source_file_id")
    return c.select("_source_file_id", "cell_id", r6("elev_mean").alias("elev_mean"), r6("slope_p90").alias("slope_p90"),
                    r6("aspect_mean_deg").alias("aspect_mean_deg"), r6("share_slope_30_45").alias("share_slope_30_45"))


@query("ingest_bronze", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 7 = 0 THEN '' ELSE lang END AS lang,
       CAST(n_chars AS VARCHAR) AS n_chars, text AS text_body
FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 2 = 1""")
def q_ingest_bronze(spark: SparkSession, sf: str):
    """Documents landed as CSV per source folder (some fields empty), beside files with a field too many;
    sources with an even number are already in the ledger with a newer time and are skipped, the bad
    files are rejected; the rest is loaded with cleaned names."""
    d = table(spark, sf, "documents")
    work = scratch_path(spark, "ingest")
    landing = f"{work}/landing"
    lang = F.when(F.pmod("doc_id", F.lit(7)) == 0, F.lit("")).otherwise(F.col("lang"))
    write_delimited(d.select(F.col("doc_id").cast("string").alias("Doc ID"), lang.alias("LANG"),
                             F.col("n_chars").cast("string").alias("n-chars"), F.col("text").alias("Text Body"),
                             "source").hint("rebalance", "source"),
                    landing, sep=",", partition_by=["source"])
    bad = d.select(F.concat(F.lit("Doc ID,LANG\n"), F.col("doc_id").cast("string"), F.lit(",xx,surplus")).alias("value"))
    bad.hint("rebalance").write.option("lineSep", "\n").text(f"{landing}/bad")
    files = list_files(spark, landing, "*.csv")
    even = F.pmod(F.regexp_extract("path", r"source=src(\d+)", 1).cast("int"), F.lit(2)) == 0
    pre = files.where("path RLIKE 'source=src'").where(even).select(
        F.col("path").alias("file_id"), F.col("path").alias("file_path"), F.col("name").alias("file_name"),
        F.lit("9999-12-31T00:00:00.000Z").alias("modified_time"))
    ledger = f"{work}/_ledger"
    record_ledger(ledger_rows(pre, pre.select(F.col("file_id").alias("_source_file_id")), "bronze_docs"), ledger)
    ingest_flow(spark, landing, "*.[ct][sx][vt]", f"{work}/bronze_docs", ledger, "bronze_docs", sep=",", multi_line=True,
                raise_on_errors=False)
    b = spark.read.option("mergeSchema", True).parquet(f"{work}/bronze_docs")
    return b.select("doc_id", "lang", "n_chars", "text_body")


@query("terrain_blocks", f"""
WITH {CELLS_SQL}
SELECT tile_id, 'E' || cell_e || '_N' || cell_n AS cell_id, round(elev_mean, 6) AS elev_mean,
       round(slope_p90, 6) AS slope_p90, round(aspect_mean_deg, 6) AS aspect_mean_deg,
       round(share_slope_30_45, 6) AS share_slope_30_45
FROM cells""")
def q_terrain_blocks(spark: SparkSession, sf: str):
    """The rasters cut into blocks that are stored bucketed; gradients across block borders come from halo lines."""
    px = events_pixels(spark, sf)
    rows = px.groupBy("tile_id", "e_min", "n_max", "row").agg(F.array_sort(F.collect_list(F.struct("col", "z"))).alias("cz"))
    tiles = rows.groupBy("tile_id", "e_min", "n_max").agg(
        F.array_sort(F.collect_list(F.struct("row", F.col("cz.z").alias("zr")))).alias("rz"))
    tiles = tiles.select("tile_id", "e_min", "n_max", F.col("rz.zr").alias("z"))
    blocks = KeyedTable(spark, scratch_path(spark, "blocks"), ["tile_id", *BLOCK], ["version"], buckets=8)
    blocks.write(cut_blocks(tiles, 10, RASTER_RES).withColumn("version", F.lit(1)))
    c = terrain_cells_from_blocks(blocks.read(), RASTER_RES, RASTER_CELL)
    return c.select("tile_id", "cell_id", r6("elev_mean").alias("elev_mean"), r6("slope_p90").alias("slope_p90"),
                    r6("aspect_mean_deg").alias("aspect_mean_deg"), r6("share_slope_30_45").alias("share_slope_30_45"))
