"""Terrain features straight from tile rows (``array<array<double>>`` rasters), with no shuffle.

When the input is one row per decoded tile — the shape a raster archive has — every pixel
of a tile is already in one row, so gradients, slope/aspect and the k×k block statistics are
computed inside that row with built-in higher-order array functions (JVM-side), and only the
cells are exploded. The plan is scan → project → generate → project: no exchange, so the
work scales with the tile count and nothing but finished cells is ever written out.

Definitions are those of the pixel-row operators in :mod:`alpina.operators.terrain` (the two
are cross-checked in tests): numpy-style gradient (central inside, one-sided at the edges),
NaN = no data, population std, exact 90th percentile with linear interpolation, shares over
valid slopes, circular mean of aspects with slope ≥ 1°.

Intermediate arrays are bound through single-element ``explode`` steps: a Generate is a
barrier Catalyst does not collapse, so an array is never re-derived inside a lambda that
runs once per element.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.fixed_values import MIN_RESULTANT, MIN_SLOPE_FOR_ASPECT_DEG, SLOPE_PERCENTILE, STEEP_BAND_DEG
from alpina.operators.terrain import block_size

_ND = "CAST(NULL AS DOUBLE)"


def _v(expr: str) -> str:
    """A raster element with NaN read as no data."""
    return f"nanvl({expr}, {_ND})"


def _pixel_struct() -> str:
    """Per pixel: z, slope, cos/sin of aspect (NULL below 1° slope), from the raw raster ``z`` with
    pixels of ``_res`` metres."""
    r1, r2 = "_res", "(2D * _res)"
    de = (f"CASE WHEN size(r) < 2 THEN {_ND} "
          f"WHEN j = 0 THEN ({_v('r[1]')} - {_v('r[0]')}) / {r1} "
          f"WHEN j = size(r) - 1 THEN ({_v('r[j]')} - {_v('r[j - 1]')}) / {r1} "
          f"ELSE ({_v('r[j + 1]')} - {_v('r[j - 1]')}) / {r2} END")
    drow = (f"CASE WHEN size(z) < 2 THEN {_ND} "
            f"WHEN i = 0 THEN ({_v('z[1][j]')} - {_v('z[0][j]')}) / {r1} "
            f"WHEN i = size(z) - 1 THEN ({_v('z[i][j]')} - {_v('z[i - 1][j]')}) / {r1} "
            f"ELSE ({_v('z[i + 1][j]')} - {_v('z[i - 1][j]')}) / {r2} END")
    grad = f"named_struct('z', {_v('x')}, 'de', {de}, 'dn', -({drow}))"
    angles = ("named_struct('z', g.z, 'slope', degrees(atan(hypot(g.de, g.dn))), "
              "'aspect', pmod(degrees(atan2(-g.de, -g.dn)), 360D))")
    final = ("named_struct('z', h.z, 'slope', h.slope, "
             f"'cos_a', CASE WHEN h.slope >= {MIN_SLOPE_FOR_ASPECT_DEG!r}D THEN cos(radians(h.aspect)) END, "
             f"'sin_a', CASE WHEN h.slope >= {MIN_SLOPE_FOR_ASPECT_DEG!r}D THEN sin(radians(h.aspect)) END)")
    return (f"transform(z, (r, i) -> transform(r, (x, j) -> "
            f"transform(transform(array({grad}), g -> {angles}), h -> {final})[0]))")


def fits_blocks(cell_size: int, res: Column, z_col: str = "z") -> Column:
    """Whether a raster is rectangular and divides into whole cells of ``cell_size`` metres at pixels of
    ``res`` metres (NULL rasters and resolutions do not)."""
    k = F.round(F.lit(float(cell_size)) / res)
    h, w = F.size(z_col), F.coalesce(F.size(F.get(F.col(z_col), 0)), F.lit(0))
    even = (F.abs(k * res - cell_size) < 1e-9) & (k > 0)
    rows = F.forall(z_col, lambda r: F.coalesce(F.size(r) == w, F.lit(False)))
    return F.coalesce(even & (h > 0) & (w > 0) & (h % k == 0) & (w % k == 0) & rows, F.lit(False))


def _bind(df: DataFrame, name: str, expr) -> DataFrame:
    """Materialise one expression as a column behind a Generate barrier."""
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, F.explode(F.array(expr)).alias(name))


def terrain_cells_from_tiles(tiles: DataFrame, res: float | str, cell_size: int, keys: tuple[str, ...] = ("tile_id",),
                             left_col: str = "e_min", top_col: str = "n_max", z_col: str = "z",
                             extra: tuple[str, ...] = ()) -> DataFrame:
    """Tile rows → one row per k×k cell with the same columns as ``terrain_cells``. ``res`` is the pixel size
    in metres, or the name of a column that holds it per tile.

    The blocks are cut inside the row and exploded once, each with its own pixels only: a row never carries
    more than its block. A raster that is ragged or does not divide into blocks fails the query."""
    if not isinstance(res, str):
        block_size(cell_size, res)
    size = F.col(res).cast("double") if isinstance(res, str) else F.lit(float(res))
    base = tiles.select(*keys, left_col, top_col, *extra, F.col(z_col).alias("z"), size.alias("_res"))
    guard = F.when((F.size("z") > 0) & ~fits_blocks(cell_size, F.col("_res")),
                   F.raise_error(F.lit(f"raster does not divide into blocks of {cell_size} m")).cast("int"))
    k = F.coalesce(guard, F.round(F.lit(float(cell_size)) / F.col("_res")).cast("int"))
    base = base.select("*", k.alias("_k"))
    px = _bind(base, "pix", F.expr(_pixel_struct())).drop("z")
    return cells_of_pixels(px, cell_size, keys, left_col, top_col, extra)


def cells_of_pixels(px: DataFrame, cell_size: int, keys: tuple[str, ...], left_col: str, top_col: str,
                    extra: tuple[str, ...]) -> DataFrame:
    """Cells of rasters whose pixels (``pix``, see ``_pixel_struct``) divide into blocks of ``_k`` pixels."""
    nrow, ncol = F.floor(F.size("pix") / F.col("_k")), F.floor(F.coalesce(F.size(F.get(F.col("pix"), 0)), F.lit(0)) / F.col("_k"))
    px = px.select("*", nrow.cast("int").alias("_nr"), ncol.cast("int").alias("_nc"))
    blocks = F.expr("transform(IF(_nr * _nc > 0, sequence(0, _nr * _nc - 1), CAST(array() AS array<int>)), c -> named_struct("
                    "'cell_row', CAST(c DIV _nc AS BIGINT), 'cell_col', CAST(c % _nc AS BIGINT), 'v', flatten(transform("
                    "slice(pix, CAST(c DIV _nc AS INT) * _k + 1, _k), r -> slice(r, (c % _nc) * _k + 1, _k)))))")
    cells = px.select(*keys, left_col, top_col, *extra, F.col("_k").alias("_side"), F.explode(blocks).alias("_block"))
    cells = cells.select(*keys, left_col, top_col, *extra, "_side", "_block.cell_row", "_block.cell_col", "_block.v")
    arrays = F.struct(
        F.expr("filter(transform(v, e -> e.z), x -> x IS NOT NULL)").alias("zs"),
        F.expr("array_sort(filter(transform(v, e -> e.slope), x -> x IS NOT NULL))").alias("ss"),
        F.expr("filter(transform(v, e -> e.cos_a), x -> x IS NOT NULL)").alias("cs"),
        F.expr("filter(transform(v, e -> e.sin_a), x -> x IS NOT NULL)").alias("sn"),
    )
    cells = _bind(cells, "b", arrays).drop("v")
    # Welford running moments of the valid elevations (one pass, numerically stable)
    moments = F.expr(
        "aggregate(b.zs, named_struct('n', 0L, 'mean', 0D, 'm2', 0D), (a, x) -> named_struct("
        "'n', a.n + 1, 'mean', a.mean + (x - a.mean) / (a.n + 1), "
        "'m2', a.m2 + (x - a.mean) * (x - (a.mean + (x - a.mean) / (a.n + 1)))))")
    cells = _bind(cells, "m", moments)
    nz, ns = F.size("b.zs"), F.size("b.ss")
    band_lo, band_hi = STEEP_BAND_DEG

    def mean_of(arr: str):
        return F.expr(f"CASE WHEN size({arr}) > 0 THEN aggregate({arr}, 0D, (a, x) -> a + x) / size({arr}) END")

    pos = F.lit(SLOPE_PERCENTILE) * (ns - 1)
    lo, hi = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    lo_v, hi_v = F.col("b.ss")[lo], F.col("b.ss")[hi]
    p90 = (F.when(ns == 0, F.lit(None).cast("double"))
           .when((lo == hi) | (lo_v == hi_v), lo_v)
           .otherwise((hi.cast("double") - pos) * lo_v + (pos - lo.cast("double")) * hi_v))
    out = cells.where(nz > 0).select(
        *keys, left_col, top_col, *extra, "cell_row", "cell_col",
        mean_of("b.zs").alias("elev_mean"),
        F.array_min("b.zs").alias("elev_min"),
        F.array_max("b.zs").alias("elev_max"),
        F.sqrt(F.col("m.m2") / F.col("m.n")).alias("elev_std"),
        mean_of("b.ss").alias("slope_mean"),
        p90.alias("slope_p90"),
        F.array_max("b.ss").alias("slope_max"),
        F.when(ns > 0, F.size(F.expr(f"filter(b.ss, x -> x >= {band_lo!r}D AND x <= {band_hi!r}D)")) / ns)
        .alias("share_slope_30_45"),
        F.when(ns > 0, F.size(F.expr(f"filter(b.ss, x -> x >= {band_lo!r}D)")) / ns).alias("share_slope_ge_30"),
        mean_of("b.cs").alias("northness"),
        mean_of("b.sn").alias("eastness"),
        (nz / (F.col("_side") * F.col("_side")).cast("double")).alias("valid_share"),
    )
    north, east = F.col("northness"), F.col("eastness")
    out = out.withColumn("aspect_mean_deg", F.when(
        F.hypot(north, east) > MIN_RESULTANT, F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))))
    ce = F.round(F.col(left_col) + F.col("cell_col") * cell_size).cast("int")
    cn = F.round(F.col(top_col) - (F.col("cell_row") + 1) * cell_size).cast("int")
    return (out.withColumn("cell_e", ce).withColumn("cell_n", cn)
            .withColumn("cell_id", F.concat(F.lit("E"), F.col("cell_e").cast("string"),
                                            F.lit("_N"), F.col("cell_n").cast("string")))
            .withColumn("center_e", F.col("cell_e") + F.lit(cell_size / 2.0))
            .withColumn("center_n", F.col("cell_n") + F.lit(cell_size / 2.0))
            .withColumn("cell_size_m", F.lit(cell_size).cast("int"))
            .drop(left_col, top_col))


def tile_stats_from_tiles(tiles: DataFrame, keys: tuple[str, ...] = ("tile_id",), z_col: str = "z",
                          extra: tuple[str, ...] = ()) -> DataFrame:
    """Per tile row: min / max / mean of valid pixels (NULL if none), no-data share, size."""
    flat = F.expr(f"flatten(transform({z_col}, r -> transform(r, x -> nanvl(x, {_ND}))))")
    t = _bind(tiles.select(*keys, *extra, z_col), "_all", flat)
    t = _bind(t, "_ok", F.expr("filter(_all, x -> x IS NOT NULL)"))
    n_all, n_ok = F.size("_all"), F.size("_ok")
    return t.select(
        *keys, *extra,
        F.array_min("_ok").alias("elev_min"),
        F.array_max("_ok").alias("elev_max"),
        F.when(n_ok > 0, F.expr("aggregate(_ok, 0D, (a, x) -> a + x)") / n_ok).alias("elev_mean"),
        (F.lit(1.0) - F.try_divide(n_ok, n_all)).alias("nodata_share"),  # NULL for an empty raster
        F.coalesce(F.size(F.get(F.col(z_col), 0)), F.lit(0)).cast("int").alias("width_px"),
        F.size(z_col).cast("int").alias("height_px"),
    )
