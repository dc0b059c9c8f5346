"""Terrain chain against pixel-by-pixel formulas and closed forms (planes): NaN no-data, tile edges, an
all-no-data block, the divisibility guard, per-tile pixel sizes and tiles of real size."""

import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from alpina.operators.terrain import raster_to_pixels, terrain_cells, tile_stats
from alpina.operators.terrain_tiles import terrain_cells_from_tiles, tile_stats_from_tiles

TILE = "tile_id string, e_min double, n_max double, z array<array<double>>"


def rise(line, i, res):
    """Change per metre at place i of a line: central inside, one-sided at the ends; None next to no data."""
    low, high = max(i - 1, 0), min(i + 1, len(line) - 1)
    if line[low] is None or line[high] is None:
        return None
    return (line[high] - line[low]) / ((high - low) * res)


def pixel(z, i, j, res):
    """(slope, aspect) in degrees of one pixel, None without data. Aspect is the direction of descent."""
    east, south = rise(z[i], j, res), rise([r[j] for r in z], i, res)
    if east is None or south is None:
        return None
    slope = math.degrees(math.atan(math.sqrt(east ** 2 + south ** 2)))
    return slope, math.degrees(math.atan2(-east, south)) % 360


def expected_cells(z, res, k, left, top):
    out = {}
    for i0 in range(0, len(z), k):
        for j0 in range(0, len(z[0]), k):
            places = [(i, j) for i in range(i0, i0 + k) for j in range(j0, j0 + k)]
            heights = [z[i][j] for i, j in places if z[i][j] is not None]
            if not heights:
                continue
            found = [p for p in (pixel(z, i, j, res) for i, j in places) if p]
            slopes = sorted(s for s, _ in found)
            facing = [math.radians(a) for s, a in found if s >= 1]
            north = statistics.fmean(map(math.cos, facing)) if facing else None
            east = statistics.fmean(map(math.sin, facing)) if facing else None
            share = lambda keep: sum(map(keep, slopes)) / len(slopes) if slopes else None
            at = 0.9 * (len(slopes) - 1)
            p90 = slopes[int(at)] + (at - int(at)) * (slopes[min(int(at) + 1, len(slopes) - 1)] - slopes[int(at)]) if slopes else None
            out[f"E{round(left + j0 * res)}_N{round(top - (i0 + k) * res)}"] = {
                "elev_mean": statistics.fmean(heights), "elev_min": min(heights), "elev_max": max(heights),
                "elev_std": statistics.pstdev(heights), "slope_mean": statistics.fmean(slopes) if slopes else None,
                "slope_p90": p90, "slope_max": slopes[-1] if slopes else None,
                "share_slope_30_45": share(lambda s: 30 <= s <= 45), "share_slope_ge_30": share(lambda s: s >= 30),
                "northness": north, "eastness": east, "valid_share": len(heights) / k ** 2,
                "aspect_mean_deg": math.degrees(math.atan2(east, north)) % 360 if facing and math.hypot(north, east) > 0.05 else None}
    return out


@pytest.mark.parametrize("path", ["pixels", "tiles"])
@pytest.mark.parametrize("seed", [0, 1])
def test_cells_equal_pixel_formulas(spark, seed, path):
    rng = np.random.default_rng(seed)
    res, k = 2.0, 4
    z = rng.normal(1500, 40, size=(12, 16)).cumsum(axis=1) / 5
    z[rng.random(z.shape) < 0.1] = np.nan          # scattered no-data
    z[0:4, 4:8] = np.nan                           # a block with no valid pixel
    left, top = 2600000.0 + seed * 1000, 1200000.0
    raster = [[None if np.isnan(v) else float(v) for v in row] for row in z]
    tiles = spark.createDataFrame([("t1", left, top, raster)], TILE)
    if path == "pixels":
        df = terrain_cells(raster_to_pixels(tiles, "z", ("tile_id", "e_min", "n_max")), res, int(k * res))
    else:
        df = terrain_cells_from_tiles(tiles, res, int(k * res))
    cells = {r["cell_id"]: r.asDict() for r in df.collect()}
    expect = expected_cells(raster, res, k, left, top)
    assert set(cells) == set(expect)
    for cid, e in expect.items():
        for col, v in e.items():
            assert cells[cid][col] == (v if v is None else pytest.approx(v, rel=1e-9, abs=1e-9)), (cid, col)


@pytest.mark.parametrize("res", [0.5, 2.0])
def test_planes_have_their_slope_and_aspect_at_any_pixel_size(spark, res):
    """A plane that falls to the south-east by tan(40 degrees)."""
    n, fall = int(20 / res), math.tan(math.radians(40)) / math.sqrt(2)
    z = [[1000 - fall * res * (i + j) for j in range(n)] for i in range(n)]
    tiles = spark.createDataFrame([("t", 0.0, 20.0, z, res)], TILE + ", px double")
    rows = terrain_cells_from_tiles(tiles, "px", 10).collect()
    assert len(rows) == 4
    for r in rows:
        assert r["slope_mean"] == pytest.approx(40) and r["aspect_mean_deg"] == pytest.approx(135)
        assert r["share_slope_30_45"] == 1.0 and r["valid_share"] == 1.0


def test_tiles_of_real_size(spark):
    """Four 500 x 500 tiles with cells of 50 m: a row never carries more than its block."""
    line = F.transform(F.sequence(F.lit(0), F.lit(499)), lambda j: (j * 1.0))
    raster = F.transform(F.sequence(F.lit(0), F.lit(499)), lambda i: F.transform(line, lambda x: x + i * 2.0))
    tiles = spark.range(4, numPartitions=4).select(F.col("id").cast("string").alias("tile_id"), F.lit(0.0).alias("e_min"),
                                                  F.lit(1000.0).alias("n_max"), raster.alias("z"))
    got = terrain_cells_from_tiles(tiles, 2.0, 50).agg(F.count(F.lit(1)), F.min("slope_mean"), F.max("slope_mean")).first()
    want = math.degrees(math.atan(math.hypot(0.5, 1.0)))
    assert got[0] == 1600 and got[1] == pytest.approx(want) and got[2] == pytest.approx(want)


def test_nan_input_is_no_data(spark):
    tiles = spark.createDataFrame([("t", [[1.0, float("nan")], [3.0, 4.0]])], "tile_id string, z array<array<double>>")
    px = raster_to_pixels(tiles)
    assert px.where(F.col("z").isNull()).count() == 1
    t = tile_stats(px).first()
    assert t["elev_max"] == 4.0 and abs(t["nodata_share"] - 0.25) < 1e-12


def test_uneven_grid_fails(spark):
    z = [[float(i + j) for j in range(6)] for i in range(4)]
    tiles = spark.createDataFrame([("t", 0.0, 100.0, z)], "tile_id string, e_min double, n_max double, z array<array<double>>")
    px = raster_to_pixels(tiles, "z", ("tile_id", "e_min", "n_max"))
    with pytest.raises(Exception, match="does not divide"):
        terrain_cells(px, 1.0, 4).collect()
    with pytest.raises(ValueError):
        terrain_cells(px, 2.0, 3)


def test_single_exchange_in_terrain_plan(spark):
    from conftest import SF001
    from alpina.plans.fixtures import events_pixels
    df = terrain_cells(events_pixels(spark, SF001), 2.0, 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


def test_tile_path_has_no_exchange_and_matches_tile_stats(spark):
    z = [[1.0, 2.0, float("nan"), 4.0], [5.0, 6.0, 7.0, 8.0]]
    tiles = spark.createDataFrame([("t", 0.0, 10.0, z)], "tile_id string, e_min double, n_max double, z array<array<double>>")
    df = terrain_cells_from_tiles(tiles, 1.0, 2)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    a = tile_stats_from_tiles(tiles).first().asDict()
    b = tile_stats(raster_to_pixels(tiles)).first().asDict()
    assert a == b


def test_tile_path_uneven_grid_fails(spark):
    z = [[float(i + j) for j in range(6)] for i in range(4)]
    tiles = spark.createDataFrame([("t", 0.0, 100.0, z)], "tile_id string, e_min double, n_max double, z array<array<double>>")
    with pytest.raises(Exception, match="does not divide"):
        terrain_cells_from_tiles(tiles, 1.0, 4).collect()


FLOW_TILE = ("tile_id string, year int, tile_e_km int, tile_n_km int, resolution_m double, crs string, e_min double, n_max double, "
             "_source_file_id string, _source_file string, _source_modified_at timestamp, z array<array<double>>")


def flow_tile(name, z, res=2.0, day=1):
    from datetime import datetime
    return (name, 2024, 2600, 1200, res, "EPSG:2056", 0.0, 8.0, f"f{name}", f"{name}.tif", datetime(2024, 5, day, 12, 0, 0, 500000), z)


def even(n, step=1.0):
    return [[float(i * 3 + j) * step for j in range(n)] for i in range(n)]


def test_terrain_flow_stores_catalog_cells_and_both_ledger_rows(spark, scratch):
    from alpina.plans.flows import terrain_flow
    from alpina.sinks.tables import read_replaced
    work = scratch("tflow")
    tiles = spark.createDataFrame([flow_tile("a", even(4)), flow_tile("b", even(16), res=0.5)], FLOW_TILE)
    s = terrain_flow(tiles, work, 4, f"{work}/_ledger").first()
    assert (s["tiles"], s["cells"]) == (2, 8)
    a = {r["tile_id"]: r for r in read_replaced(spark, f"{work}/terrain_tiles", "_source_file_id").collect()}
    assert (a["b"]["e_max"], a["b"]["n_min"], a["b"]["resolution_m"], a["b"]["width_px"]) == (8.0, 0.0, 0.5, 16)
    assert a["a"]["tile_e_km"] == 2600 and a["a"]["crs"] == "EPSG:2056" and a["a"]["_ingested_at"] is not None
    ledger = spark.read.parquet(f"{work}/_ledger").collect()
    assert sorted((r["file_id"], r["target_table"], r["row_count"]) for r in ledger) == [
        ("fa", "terrain_cells", 4), ("fa", "terrain_tiles", 1), ("fb", "terrain_cells", 4), ("fb", "terrain_tiles", 1)]
    assert {r["modified_time"] for r in ledger} == {"2024-05-01T12:00:00.500Z"}
    # nothing changed: nothing is read or logged; a newer tile alone is replaced
    terrain_flow(tiles, work, 4, f"{work}/_ledger")
    assert spark.read.parquet(f"{work}/_ledger").count() == 4
    newer = spark.createDataFrame([flow_tile("a", even(4, 5.0), day=2), flow_tile("b", even(16, 5.0), res=0.5)], FLOW_TILE)
    assert terrain_flow(newer, work, 4, f"{work}/_ledger").first()["cells"] == 8
    assert spark.read.parquet(f"{work}/_ledger").count() == 6
    a = {r["tile_id"]: r["elev_max"] for r in read_replaced(spark, f"{work}/terrain_tiles", "_source_file_id").collect()}
    assert a == {"a": 60.0, "b": 60.0}


def test_terrain_flow_quarantines_bad_tiles_and_fails_at_end(spark, scratch):
    from alpina.operators.quality import QuarantineError
    from alpina.plans.flows import terrain_flow
    from alpina.sinks.tables import read_replaced
    ragged = [[1.0, 2.0, 3.0, 4.0], [1.0, 2.0]] * 2
    tiles = spark.createDataFrame([flow_tile("ok", even(4)), flow_tile("uneven", [[1.0, 2.0, 3.0]] * 4), flow_tile("ragged", ragged),
                                   flow_tile("empty", []), flow_tile("size", even(4), res=3.0)], FLOW_TILE)
    work = scratch("tbad")
    with pytest.raises(QuarantineError):
        terrain_flow(tiles, work, 4, f"{work}/_ledger")
    assert {r["tile_id"] for r in read_replaced(spark, f"{work}/terrain_cells", "_source_file_id").collect()} == {"ok"}
    assert {r["file_id"] for r in spark.read.parquet(f"{work}/_ledger").collect()} == {"fok"}
    errors = {r["tile_id"]: r["message"] for r in spark.read.parquet(f"{work}/_errors").collect()}
    assert set(errors) == {"uneven", "ragged", "empty", "size"} and "4x3" in errors["uneven"]


def test_empty_raster_has_no_size(spark):
    tiles = spark.createDataFrame([("t0", 0.0, 8.0, [])], TILE)
    assert tile_stats_from_tiles(tiles).first()["width_px"] == 0
    assert terrain_cells_from_tiles(tiles, 1.0, 2).collect() == []
