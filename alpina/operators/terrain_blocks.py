"""Terrain features of rasters that do not fit in a row: blocks with a one-pixel halo.

A raster is cut into a grid of blocks, one row each. Gradients at a block's border need the pixels just outside it, so each
block keeps its four border lines as columns of their own and sends them to its neighbours. Only these lines
are shuffled (a scan reads them without the pixels); blocks from a table bucketed by raster and block, such as a
:class:`~alpina.sinks.keyed.KeyedTable`, are joined where they lie, others are shuffled once by Spark.

Results are those of :func:`alpina.operators.terrain_tiles.terrain_cells_from_tiles` on the whole raster. Where a neighbour
is absent the block's border is the raster's edge (one-sided gradient). A block that is ragged, does not divide into
cells or has a neighbour of another side length fails the query; (keys, block) must be unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.operators.terrain import block_size
from alpina.operators.terrain_tiles import _bind, _pixel_struct, cells_of_pixels, fits_blocks

BLOCK = ("block_row", "block_col")
BORDERS = ("border_n", "border_s", "border_w", "border_e")
# a border line becomes the halo of the neighbour on that side: (line, rows down, columns right, side it arrives at)
SENT = (("border_n", -1, 0, "s"), ("border_s", 1, 0, "n"), ("border_w", 0, -1, "e"), ("border_e", 0, 1, "w"))


def with_borders(blocks: DataFrame, z_col: str = "z") -> DataFrame:
    """Blocks with their four border lines, to be stored beside the pixels."""
    z = F.col(z_col)
    return blocks.select("*", F.element_at(z, 1).alias("border_n"), F.element_at(z, -1).alias("border_s"),
                         F.transform(z, lambda r: F.element_at(r, 1)).alias("border_w"),
                         F.transform(z, lambda r: F.element_at(r, -1)).alias("border_e"))


def cut_blocks(tiles: DataFrame, block_px: int, res: float | str, keys: tuple[str, ...] = ("tile_id",), left_col: str = "e_min",
               top_col: str = "n_max", z_col: str = "z", extra: tuple[str, ...] = ()) -> DataFrame:
    """Blocks of at most ``block_px`` x ``block_px`` pixels of tile rows, with their own west and north edges, their first
    pixel (``row0``, ``col0``) and their borders. Decoders that read windows make such rows without a tile row."""
    size = F.col(res).cast("double") if isinstance(res, str) else F.lit(float(res))
    t = tiles.where(F.size(z_col) > 0).select(*keys, F.col(left_col).alias("_left"), F.col(top_col).alias("_top"), *extra,
                                              size.alias("_res"), F.col(z_col).alias("z"))
    t = t.where("size(z[0]) > 0")
    rows = t.select("*", F.explode(F.expr(f"sequence(0, (size(z) - 1) DIV {block_px})")).alias("_br"))
    strips = rows.select(*[c for c in rows.columns if c not in ("z", "_br")], F.col("_br").cast("int").alias("block_row"),
                         F.expr(f"slice(z, CAST(_br AS INT) * {block_px} + 1, {block_px})").alias("z"))
    parts = strips.select("*", F.explode(F.expr(f"sequence(0, (size(z[0]) - 1) DIV {block_px})")).alias("_bc"))
    out = parts.select(*[c for c in parts.columns if c not in ("z", "_bc")], F.col("_bc").cast("int").alias("block_col"),
                       F.expr(f"transform(z, r -> slice(r, CAST(_bc AS INT) * {block_px} + 1, {block_px}))").alias("z"))
    out = out.select("*", (F.col("block_row") * block_px).alias("row0"), (F.col("block_col") * block_px).alias("col0"))
    placed = out.select(*keys, *BLOCK, "row0", "col0", (F.col("_left") + F.col("col0") * F.col("_res")).alias(left_col),
                        (F.col("_top") - F.col("row0") * F.col("_res")).alias(top_col), *extra, "z")
    return with_borders(placed)


def halos(blocks: DataFrame, keys: tuple[str, ...] = ("tile_id",)) -> DataFrame:
    """Per block the neighbours' lines ``halo_n``, ``halo_s``, ``halo_w``, ``halo_e`` (null without a neighbour)."""
    sent = F.explode(F.array(*[
        F.struct((F.col("block_row") + down).cast("int").alias("block_row"), (F.col("block_col") + right).cast("int").alias("block_col"),
                 F.lit(side).alias("side"), F.col(line).alias("line")) for line, down, right, side in SENT]))
    lines = blocks.select(*keys, *BLOCK, *BORDERS).select(*keys, sent.alias("_sent")).select(*keys, "_sent.*")
    return lines.groupBy(*keys, *BLOCK).agg(*[F.max(F.when(F.col("side") == s, F.col("line"))).alias(f"halo_{s}") for s in "nswe"])


def terrain_cells_from_blocks(blocks: DataFrame, res: float | str, cell_size: int, keys: tuple[str, ...] = ("tile_id",),
                              left_col: str = "e_min", top_col: str = "n_max", extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per cell with the columns of ``terrain_cells_from_tiles``; ``cell_row`` and ``cell_col`` count in the raster."""
    if not isinstance(res, str):
        block_size(cell_size, res)
    size = F.col(res).cast("double") if isinstance(res, str) else F.lit(float(res))
    own = blocks.select(*keys, *BLOCK, "row0", "col0", left_col, top_col, *extra, "z", size.alias("_res"))
    t = own.join(halos(blocks, keys), [*keys, *BLOCK], "left")

    def other_length(side: str, length):
        return F.coalesce(F.size(f"halo_{side}") != length, F.lit(False)) & F.col(f"halo_{side}").isNotNull()

    high, wide = F.size("z"), F.size(F.get(F.col("z"), 0))
    uneven = other_length("n", wide) | other_length("s", wide) | other_length("w", high) | other_length("e", high)
    k = (F.when(~fits_blocks(cell_size, F.col("_res")), F.raise_error(F.lit(f"block does not divide into cells of {cell_size} m")).cast("int"))
         .when(uneven, F.raise_error(F.lit("neighbouring blocks differ in their side")).cast("int"))
         .otherwise(F.round(F.lit(float(cell_size)) / F.col("_res")).cast("int")))
    t = t.select("*", k.alias("_k"))
    none = "CAST(array() AS array<double>)"
    corner = {s: f"IF(halo_{s} IS NULL, {none}, array(CAST(NULL AS DOUBLE)))" for s in "we"}  # no gradient reads a corner
    west, east = (f"IF(halo_{s} IS NULL, {none}, array(halo_{s}[i]))" for s in "we")
    line = {s: f"IF(halo_{s} IS NULL, CAST(array() AS array<array<double>>), array(concat({corner['w']}, halo_{s}, {corner['e']})))" for s in "ns"}
    ringed = F.expr(f"concat({line['n']}, transform(z, (r, i) -> concat({west}, r, {east})), {line['s']})")
    kept = t.select("*", F.when(F.col("halo_n").isNull(), 0).otherwise(1).alias("_dn"), F.when(F.col("halo_w").isNull(), 0).otherwise(1).alias("_dw"),
                    high.alias("_h"), wide.alias("_w"))
    px = _bind(kept, "z", ringed).drop("halo_n", "halo_s", "halo_w", "halo_e")
    px = _bind(px, "pix", F.expr(_pixel_struct())).drop("z")
    px = _bind(px, "pix", F.expr("transform(slice(pix, _dn + 1, _h), r -> slice(r, _dw + 1, _w))"))
    own_row = F.round(F.col("row0") * F.col("_res") / cell_size).cast("long").alias("_cell_row0")
    own_col = F.round(F.col("col0") * F.col("_res") / cell_size).cast("long").alias("_cell_col0")
    px = px.select(*keys, left_col, top_col, *extra, own_row, own_col, "_k", "pix")
    cells = cells_of_pixels(px, cell_size, keys, left_col, top_col, (*extra, "_cell_row0", "_cell_col0"))
    return (cells.withColumn("cell_row", F.col("cell_row") + F.col("_cell_row0"))
            .withColumn("cell_col", F.col("cell_col") + F.col("_cell_col0")).drop("_cell_row0", "_cell_col0"))
