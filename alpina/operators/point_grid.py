"""Points joined to the grid cells that hold them, whatever the share of one cell.

The points of each cell are counted first (map-side combined). A cell with more than ``split_rows`` points is cut into
parts: its points are dealt to the parts by a hash, its cell rows are given to each part. All other cells
have one part. The list of cut cells is broadcast; ``split_rows`` is raised to a share of the number of points, so
that list never has more than ``MOST_CUT`` entries, and the raise also bounds the points of a part.

Defined results: points with a null coordinate lie in no cell (kept with nulls by ``how='left'``); several rows
of one cell (years, say) each meet its points; points equal in all columns are separate rows; empty inputs give no rows
(or the points alone, by ``how='left'``). Columns that both sides have beside the cell's must be renamed by the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from alpina.functions.geo import grid_cell

SPLIT_ROWS = 2_000_000
MOST_CUT = 50_000
CELL = ["cell_e", "cell_n"]


def cut_cells(keyed: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``cell_e``, ``cell_n``, ``_parts`` of the cells with more than ``split_rows`` points: at most MOST_CUT."""
    counts = keyed.where("cell_e IS NOT NULL AND cell_n IS NOT NULL").groupBy(*CELL).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_total"))
    split = F.greatest(F.lit(split_rows).cast("long"), F.ceil(F.col("_total") / MOST_CUT))
    sized = counts.join(F.broadcast(total.select(split.alias("_split"))), F.col("_n") > F.col("_split"))
    return sized.select(*CELL, F.ceil(F.col("_n") / F.col("_split")).cast("int").alias("_parts"))


def points_in_cells(points: DataFrame, cells: DataFrame, e: str | Column, n: str | Column, size: int, *,
                    how: str = "inner", split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Every point with ``cell_e``, ``cell_n`` and the other columns of its cell's rows in ``cells``."""
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    both = (set(points.columns) & set(cells.columns)) | (set(points.columns) & {*CELL, "_parts", "_part"})
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")
    at = grid_cell(e, n, size)
    keyed = points.select("*", at["cell_e"].alias("cell_e"), at["cell_n"].alias("cell_n"))
    cut = F.broadcast(cut_cells(keyed, split_rows))
    hashed = [F.col(f"`{f.name}`") for f in points.schema.fields if not isinstance(f.dataType, MapType | VariantType)]
    # the partition id parts equal rows of different tasks; any part is a right one, all hold the cell's rows
    part = F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.coalesce("_parts", F.lit(1)))
    dealt = keyed.join(cut, CELL, "left").withColumn("_part", part.cast("int")).drop("_parts")
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    given = cells.join(cut, CELL, "left").withColumn("_part", parts).drop("_parts")
    return dealt.join(given, [*CELL, "_part"], how).drop("_part")
