"""Composed landing → bronze → silver flows, as reusable functions.

* :func:`weather_flow` — per granularity: changed files → all STRING + lineage → typed → expectations →
  SCD type 1 upsert keyed by (station, instant), newest delivery wins.
* :func:`snow_flow` — optional bronze tables → fixed value columns → union → latest
  ingested row per (station, instant) → full overwrite; stations as latest snapshot.
* :func:`terrain_flow` — changed tile rasters → gradients → cell features (in-row) →
  replace by source file → ledger → control summary.
* :func:`ingest_flow` — listing → change detection against the ledger → all-STRING read →
  cleaned names → lineage → run folder → ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.fixed_values import SNOW_KEYS as FIXED_SNOW_KEYS
from alpina.fixed_values import WEATHER_TECH as FIXED_WEATHER_TECH
from alpina.functions.casts import cast_double_strict
from alpina.functions.names import clean_column_name, clean_columns, clean_names
from alpina.functions.text import normalize_key
from alpina.functions.timeparse import WEATHER_TS_FORMAT, parse_ts_multi, parse_ts_strict
from alpina.operators.changes import changed_by_epoch, changed_by_time
from alpina.operators.dedupe import latest_per_key, latest_snapshot
from alpina.operators.projection import project_dynamic, project_values, station_snapshot_project, union_by_name
from alpina.operators.quality import NameCollision, QuarantineError, expect_or_drop
from alpina.operators.summary import control_summary
from alpina.operators.terrain_tiles import fits_blocks, terrain_cells_from_tiles, tile_stats_from_tiles
from alpina.session import delete_path, list_dir, path_exists, scratch_path, write_text_file
from alpina.sinks.keyed import BUCKETS, KeyedTable
from alpina.sinks.ledger import ledger_rows, record_ledger
from alpina.sinks.tables import overwrite_table, read_replaced, replace_by_key
from alpina.sources.delimited import RESCUED, frame_of_header, header_names, header_signatures, read_delimited_union
from alpina.sources.files import list_files, raw_path, source_path
from alpina.sources.json_text import read_json_strings

WEATHER_TECH = set(FIXED_WEATHER_TECH)
WEATHER_KEYS = ["station_abbr", "reference_ts"]
WEATHER_SEQUENCE = ["source_modified_at", "source_file"]


# ---------------------------------------------------------------- weather
WEATHER_TIMES = ("source_file", "source_modified_at")


def _file_listing(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    return list_files(spark, folder, pattern).select(
        F.col("path").alias("file_id"), F.col("path").alias("file_path"), F.col("name").alias("file_name"),
        F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("modified_time"))


def weather_bronze(spark: SparkSession, folder: str, bronze: str, ledger_path: str, target: str,
                   sep: str = ";") -> DataFrame | None:
    """Load the files of one granularity that are new or rewritten since the ledger saw them (the same path
    with a later time is read again): all STRING, lineage, columns bound by name, so a new column is
    added without failing; fields beyond a file's header are kept in ``_rescued``. Every run is a folder of its own. Returns the
    run's rows (None: nothing to do)."""
    listing = _file_listing(spark, folder, "*.csv")
    settle_runs(spark, bronze, ledger_path, target)
    todo = changed_by_epoch(listing, spark.read.parquet(ledger_path), target=target) if path_exists(spark, ledger_path) else listing
    paths = [raw_path(r["file_path"]) for r in todo.select("file_path").collect()]  # the files to open
    if not paths:
        return None
    rows = read_delimited_union(spark, paths, sep, "station_abbr", lineage=WEATHER_TIMES, rescued=RESCUED)
    run = start_run(todo, bronze)
    rows.withColumn("_ingested_at", F.current_timestamp()).write.mode("overwrite").parquet(run)
    stored = spark.read.parquet(run)
    finish_run(ledger_rows(todo, stored.select(F.col("source_file").alias("_source_file_id")), target), run, ledger_path)
    return stored


def weather_typed(bronze: DataFrame) -> DataFrame:
    """Typed view: key normalised, instant parsed strictly, every other column a DOUBLE."""
    lead = [normalize_key("station_abbr").alias("station_abbr"),
            parse_ts_strict("reference_timestamp", WEATHER_TS_FORMAT).alias("reference_ts")]
    return project_dynamic(bronze, WEATHER_TECH | {RESCUED}, cast=lambda c: cast_double_strict(F.col(f"`{c}`")),
                           lead=lead, tail=["source_file", "source_modified_at"])


def pending_runs(spark: SparkSession, bronze: str) -> list[str]:
    """Names of the logged runs of a bronze table whose rows are not in silver yet."""
    base = f"{bronze.rstrip('/')}/{RUN_FILES}"
    return [n for n in sorted(list_dir(spark, base))
            if path_exists(spark, f"{base}/{n}/{RUN_LOGGED}") and not path_exists(spark, f"{base}/{n}/{RUN_IN_SILVER}")]


def weather_flow(spark: SparkSession, granularities: dict[str, str], work: str, buckets: int = BUCKETS) -> dict[str, tuple[DataFrame, dict]]:
    """One silver table per granularity (name → landing folder): the newest delivery per station and
    instant. Returns per granularity the table and the counts of rows read and dropped by this run.

    Silver follows bronze run by run: a run counts as done when its rows are in silver, so a run that was logged
    by a flow that then died (or met a value that the strict types refuse) is taken up by the next one."""
    out = {}
    for name, folder in granularities.items():
        bronze = f"{work}/bronze/{name}"
        silver = KeyedTable(spark, f"{work}/silver/{name}", WEATHER_KEYS, WEATHER_SEQUENCE, buckets)
        weather_bronze(spark, folder, bronze, f"{work}/_ledger", f"bronze_{name}")
        counts = {"rows_in": 0, "valid_key_dropped": 0}
        for run in pending_runs(spark, bronze):
            stored = spark.read.parquet(f"{bronze}/run={run}")
            valid, seen = expect_or_drop(weather_typed(stored), {"valid_key": "station_abbr IS NOT NULL AND reference_ts IS NOT NULL"},
                                         f"weather_{name}_{run}")
            if silver.write(valid, f"run-{run}"):
                counts = {k: v + seen.get[k] for k, v in counts.items()}
            write_text_file(spark, f"{bronze}/{RUN_FILES}/{run}/{RUN_IN_SILVER}", "")
        silver.maintain()
        if silver.exists():
            out[name] = (silver.read(), counts)
    return out


# ---------------------------------------------------------------- snow
SNOW_KEYS = list(FIXED_SNOW_KEYS)


def snow_typed(df: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    keyed = df.select("*", normalize_key("station_code", trim=False).alias("_sc"),
                      parse_ts_multi("measure_date").alias("_md"))
    out = project_values(keyed, ["_sc", "_md"], value_cols, extra=["_source_file", "_ingested_at"])
    return out.withColumnRenamed("_sc", "station_code").withColumnRenamed("_md", "measure_date")


def snow_silver(spark: SparkSession, sources: Sequence[str], value_cols: Sequence[str]) -> DataFrame | None:
    parts = [snow_typed(spark.table(t), value_cols) for t in sources if spark.catalog.tableExists(t)]
    if not parts:
        return None
    df = union_by_name(parts)
    order = [F.col("_ingested_at"), F.col("_source_file")]
    return latest_per_key(df, SNOW_KEYS, order)


def snow_flow(spark: SparkSession, silver_root: str, targets: dict[str, tuple[Sequence[str], Sequence[str]]],
              stations: tuple[str, str] | None = None) -> dict[str, int]:
    """Builds every silver table whose bronze tables exist; returns row counts. ``targets`` names per silver table its bronze
    tables (those that don't exist are skipped) and its value columns, ``stations`` the (silver, bronze) tables of the
    stations' latest snapshot."""
    counts = {}
    for target, (sources, cols) in targets.items():
        df = snow_silver(spark, sources, cols)
        if df is not None:
            counts[target] = overwrite_table(df, f"{silver_root}/{target}")
    if stations and spark.catalog.tableExists(stations[1]):
        st = latest_snapshot(spark.table(stations[1]), ["code"], [F.col("_ingested_at")])
        counts[stations[0]] = overwrite_table(station_snapshot_project(st), f"{silver_root}/{stations[0]}")
    return counts


# ---------------------------------------------------------------- terrain
def terrain_flow(tiles: DataFrame, work: str, cell_size: int, ledger_path: str,
                 target_tiles: str = "terrain_tiles", target_cells: str = "terrain_cells",
                 raise_on_errors: bool = True) -> DataFrame:
    """tiles: (tile_id, year, tile_e_km, tile_n_km, resolution_m, crs, e_min, n_max, _source_file_id, _source_file,
    _source_modified_at, z array<array<double>>); every tile has its own pixel size.

    Only tiles that are new or changed since the ledger logged their cells are read. Tiles whose raster is
    empty, ragged or does not divide into cells are quarantined: written to ``<work>/_errors`` and left out of
    the ledger (retried next run), while every other tile is processed. Catalog and cells are replaced by
    source file id, both are logged with the source's time, and the one-row control summary is returned — or,
    if tiles were rejected, ``QuarantineError`` is raised after all of that is stored."""
    spark = tiles.sparkSession
    listing = tiles.select(F.col("_source_file_id").alias("file_id"), F.col("_source_file").alias("file_path"),
                           F.col("_source_file").alias("file_name"),
                           F.date_format("_source_modified_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("modified_time"))
    if path_exists(spark, ledger_path):
        listing = changed_by_epoch(listing, spark.read.parquet(ledger_path), target=target_cells)
    # one narrow pass over the rasters decides which tiles fit; later steps read this small table
    h, w = F.size("z"), F.coalesce(F.size(F.get(F.col("z"), 0)), F.lit(0))
    shapes = tiles.select("tile_id", "_source_file_id", "_source_file", fits_blocks(cell_size, F.col("resolution_m")).alias("fits"),
                          F.concat(h.cast("string"), F.lit("x"), w.cast("string")).alias("shape"))
    stage = scratch_path(spark, "terrain_todo")
    listing.join(shapes, F.col("file_id") == F.col("_source_file_id")).write.parquet(stage)
    todo = spark.read.parquet(stage)
    bad = todo.where("NOT fits").select("tile_id", "_source_file_id", "_source_file", F.concat(
        F.lit(f"raster is empty, ragged or does not divide into cells of {cell_size} m: "), "shape").alias("message"))
    n_bad = bad.count()
    if n_bad:
        bad.write.mode("append").parquet(f"{work}/_errors")
    fine = todo.where("fits")
    ids = fine.select("_source_file_id")
    good = tiles.join(ids, "_source_file_id", "left_semi")
    # tile rows already hold every pixel of a tile: compute in-row
    now = F.current_timestamp().alias("_ingested_at")
    lineage = ("year", "_source_file", "_source_file_id", "_source_modified_at")
    catalog = ("tile_e_km", "tile_n_km", "resolution_m", "crs", "e_min", "n_max")
    stats = tile_stats_from_tiles(good, keys=("tile_id",), extra=(*lineage, *catalog))
    stats = (stats.withColumn("e_max", F.col("e_min") + F.col("width_px") * F.col("resolution_m"))
             .withColumn("n_min", F.col("n_max") - F.col("height_px") * F.col("resolution_m")).select("*", now))
    cells = terrain_cells_from_tiles(good, "resolution_m", cell_size, keys=("tile_id",), extra=lineage).select("*", now)
    done = {}
    for name, rows in ((target_tiles, stats.repartitionByRange("tile_e_km", "tile_n_km")), (target_cells, cells.repartitionByRange("cell_e", "cell_n"))):
        number = replace_by_key(rows, f"{work}/{name}", "_source_file_id", ids=ids)
        done[name] = read_replaced(spark, f"{work}/{name}", "_source_file_id", batch=number)
    logged = fine.select("file_id", "file_path", "file_name", "modified_time")
    for name, rows in done.items():  # counts of this batch, read back from its own folder
        record_ledger(ledger_rows(logged, rows.select("_source_file_id"), name), ledger_path)
    one = F.lit(1)
    summary = control_summary(
        tiles=(read_replaced(spark, f"{work}/{target_tiles}", "_source_file_id"),
               {"tiles": F.count(one), "elev_min": F.round(F.min("elev_min")), "elev_max": F.round(F.max("elev_max"))}),
        cells=(read_replaced(spark, f"{work}/{target_cells}", "_source_file_id"),
               {"cells": F.count(one), "cells_steep_30_45": F.count_if(F.col("share_slope_30_45") > 0.5)}))
    if n_bad and raise_on_errors:
        raise QuarantineError(f"{n_bad} tile(s) rejected; see {work}/_errors — the next run retries them")
    return summary


# ---------------------------------------------------------------- runs
RUN_FILES, RUN_LOGGED, RUN_IN_SILVER = "_files", "_LOGGED", "_IN_SILVER"


def start_run(todo: DataFrame, target: str) -> str:
    """A new run folder of a bronze table, with the list of files it loads."""
    run = f"{target.rstrip('/')}/run={uuid.uuid4().hex[:12]}"
    todo.select("file_id", "modified_time").write.parquet(f"{target.rstrip('/')}/{RUN_FILES}/{run.rsplit('=', 1)[1]}")
    return run


def finish_run(rows: DataFrame, run: str, ledger_path: str) -> None:
    """Log the run's files, then mark its folder as logged."""
    record_ledger(rows, ledger_path)
    base, name = run.rsplit("/run=", 1)
    write_text_file(rows.sparkSession, f"{base}/{RUN_FILES}/{name}/{RUN_LOGGED}", "")


def settle_runs(spark: SparkSession, target: str, ledger_path: str, target_name: str) -> None:
    """Undo runs that died before their files were logged (those files load again), so a crash
    between the rows and the ledger duplicates nothing."""
    base = target.rstrip("/")
    for name in list_dir(spark, f"{base}/{RUN_FILES}"):
        files = f"{base}/{RUN_FILES}/{name}"
        if path_exists(spark, f"{files}/{RUN_LOGGED}"):
            continue
        logged = False
        if path_exists(spark, f"{files}/_SUCCESS") and path_exists(spark, ledger_path):
            mine = spark.read.parquet(files)
            ledger = spark.read.parquet(ledger_path).where(F.col("target_table") == target_name)
            logged = not mine.join(ledger, ["file_id", "modified_time"], "left_semi").isEmpty()
        if logged:
            write_text_file(spark, f"{files}/{RUN_LOGGED}", "")
        else:
            delete_path(spark, f"{base}/run={name}")
            delete_path(spark, files)


# ---------------------------------------------------------------- ingest
SOURCE = ("_source_file", "_source_modified_at")
REJECT = "_reject"
ERRORS = "file string, message string"


def _merged_names(df: DataFrame, technical: Sequence[str]) -> DataFrame:
    """Clean the names of columns that several files share. Names of different files that become one are
    merged; a row that has values under two of them is marked in REJECT (its file has a collision)."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        if c not in technical:
            groups.setdefault(clean_column_name(c), []).append(c)
    quoted = {n: [F.col("`" + c.replace("`", "``") + "`") for c in cs] for n, cs in groups.items()}
    clash = [F.when(sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int")) > 1,
                    F.lit(f"cleaned column names collide: {n}")) for n, cs in quoted.items() if len(cs) > 1]
    reject = F.coalesce(F.col(REJECT), *clash) if REJECT in df.columns else F.coalesce(F.lit(None).cast("string"), *clash)
    return df.select(*[F.coalesce(*cs).alias(n) for n, cs in quoted.items()], *[t for t in technical if t != REJECT], reject.alias(REJECT))


def _read_csv(spark: SparkSession, paths: list[str], sep: str, multi_line: bool) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    frames, errors = [], []
    for line, files in sorted(header_signatures(spark, paths, sep).items()):
        try:
            names = clean_names(header_names(line, sep))
        except NameCollision as e:
            errors += [(f, str(e)) for f in files]
            continue
        df = frame_of_header(spark, names, files, sep, None, multi_line, True, SOURCE, surplus="_surplus")
        reject = F.when(F.col("_surplus").isNotNull(), F.concat(F.lit("a line has more fields than the header: "), F.col("_surplus")))
        frames.append(df.withColumn(REJECT, reject).drop("_surplus"))
    return (union_by_name(frames, allow_missing=True) if frames else None), errors


def _read_json(spark: SparkSession, paths: list[str]) -> DataFrame:
    df = read_json_strings(spark, paths, corrupt_col="_corrupt_record", lineage=SOURCE)
    df = df.withColumn(REJECT, F.when(F.col("_corrupt_record").isNotNull(), F.concat(F.lit("corrupt record: "), "_corrupt_record")))
    return _merged_names(df.drop("_corrupt_record"), [*SOURCE, REJECT])


def _readable_parquet(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[tuple[str, str]]]:
    """(files Spark can read, errors of the others), by halving the list where a read fails."""
    try:
        clean_names(spark.read.option("mergeSchema", True).parquet(*paths).columns)
        spark.read.option("mergeSchema", True).parquet(*paths).write.format("noop").mode("overwrite").save()
        return paths, []
    except Exception as e:  # one bad file fails the whole read
        if len(paths) == 1:
            return [], [(paths[0], str(e).split("\n")[0])]
        good, errors = [], []
        for part in (paths[:len(paths) // 2], paths[len(paths) // 2:]):
            g, e = _readable_parquet(spark, part)
            good, errors = good + g, errors + e
        return good, errors


def _read_parquet(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[tuple[str, str]]]:
    good, errors = _readable_parquet(spark, paths)
    if not good:
        return None, errors
    df = spark.read.option("mergeSchema", True).parquet(*good)
    return clean_columns(df).select("*", source_path().alias(SOURCE[0]),
                                    F.col("_metadata.file_modification_time").alias(SOURCE[1]),
                                    F.lit(None).cast("string").alias(REJECT)), errors


def ingest_flow(spark: SparkSession, landing: str, pattern: str, target: str, ledger_path: str,
                target_name: str, sep: str = ",", fmt: str = "csv", multi_line: bool = False,
                raise_on_errors: bool = True) -> DataFrame:
    """Incremental file ingest into a bronze table: listing → change detection against the ledger →
    read (all-STRING for csv/json; an empty CSV field stays ``""``) → cleaned names → lineage → a run folder of
    its own → ledger rows for the loaded files (files without rows included).

    A file that cannot be read whole is rejected alone, whatever its format: a CSV line with more fields
    than its header, a corrupt JSON record, an unreadable Parquet file, names that collide, no content.
    Rejected files are written to ``<target>_errors`` and left out of the ledger, so the next run retries
    them; the run then fails (``QuarantineError``) after everything else is stored. Returns the ledger rows."""
    settle_runs(spark, target, ledger_path, target_name)
    listing = list_files(spark, landing, pattern)
    files = _file_listing(spark, landing, pattern).join(listing.select(F.col("path").alias("file_id"), "size"), "file_id")
    todo = changed_by_time(files, spark.read.parquet(ledger_path), target=target_name) if path_exists(spark, ledger_path) else files
    found = todo.select("file_path", "size").collect()  # the files to open
    if not found:
        return spark.createDataFrame([], "file_id string")
    errors = [(r["file_path"], "no content") for r in found if r["size"] == 0 and fmt != "json"]
    paths = [raw_path(r["file_path"]) for r in found if r["size"] > 0]
    raw = None
    if paths and fmt == "csv":
        raw, more = _read_csv(spark, paths, sep, multi_line)
    elif paths and fmt == "json":
        raw, more = _read_json(spark, paths), []
    elif paths and fmt == "parquet":
        raw, more = _read_parquet(spark, paths)
        more = [(r["file_path"], m) for p, m in more for r in found if raw_path(r["file_path"]) == p]
    elif paths:
        raise ValueError(f"unknown format {fmt!r}")
    else:
        more = []
    bad = spark.createDataFrame([*errors, *more], ERRORS)
    run = start_run(todo, target)
    loaded = spark.createDataFrame([], "_source_file_id string")
    if raw is not None:
        stage = scratch_path(spark, "ingest_stage")
        raw.write.parquet(stage)  # parsed once; both sides read the same rows
        rows = spark.read.parquet(stage)
        bad = bad.unionByName(rows.where(F.col(REJECT).isNotNull()).groupBy(F.col(SOURCE[0]).alias("file"))
                              .agg(F.min(REJECT).alias("message")))
        good = rows.join(bad.select(F.col("file").alias(SOURCE[0])), SOURCE[0], "left_anti").drop(REJECT)
        good.select(*[c for c in good.columns if c not in SOURCE], *SOURCE, F.current_timestamp().alias("_ingested_at")).write.parquet(run)
        loaded = spark.read.parquet(run).select(F.col(SOURCE[0]).alias("_source_file_id"))
    n_bad = bad.count()
    if n_bad:
        bad.withColumn("_ingested_at", F.current_timestamp()).write.mode("append").parquet(f"{target.rstrip('/')}_errors")
    ok = todo.join(bad.select(F.col("file").alias("file_id")), "file_id", "left_anti")
    rows = ledger_rows(ok, loaded, target_name)
    finish_run(rows, run, ledger_path)
    if n_bad and raise_on_errors:
        raise QuarantineError(f"{n_bad} file(s) rejected; see {target}_errors")
    return rows


__all__ = ["weather_flow", "snow_flow", "terrain_flow", "ingest_flow", "weather_bronze"]
