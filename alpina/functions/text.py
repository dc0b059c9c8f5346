"""Key normalisation and file-name parsers (asset names, raster tile names)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_key(c, trim: bool = True) -> Column:
    """``upper(trim(x))`` (weather) or ``upper(x)`` without trimming (snow)."""
    c = _col(c).cast("string")
    return F.upper(F.trim(c)) if trim else F.upper(c)


from alpina.fixed_values import ASSET_NAME_PATTERN, TILE_NAME_PATTERN  # noqa: E402


def _group(c: Column, pattern: str, i: int) -> Column:
    """Regex group, NULL when the whole name does not match or the group is empty."""
    v = F.regexp_extract(c, pattern, i)
    return F.when(c.rlike(pattern) & (v != ""), v)


def parse_asset_name(c) -> Column:
    """Asset file name → struct(station, gran, period, start_year, end_year); NULL if unparsable."""
    c = _col(c)
    p = ASSET_NAME_PATTERN
    return F.when(c.rlike(p), F.struct(
        _group(c, p, 1).alias("station"),
        _group(c, p, 2).alias("gran"),
        _group(c, p, 3).alias("period"),
        _group(c, p, 4).cast("int").alias("start_year"),
        _group(c, p, 5).cast("int").alias("end_year"),
    ))


def parse_tile_name(c) -> Column:
    """Tile file name or URL → struct(name, year, e_km, n_km, resolution, tile_id); NULL if unparsable."""
    c = _col(c)
    name = F.regexp_extract(c, r"([^/]*)$", 1)
    p = TILE_NAME_PATTERN
    ok = name.rlike(p)
    e = F.regexp_extract(name, p, 2).cast("int")
    n = F.regexp_extract(name, p, 3).cast("int")
    return F.when(ok, F.struct(
        name.alias("name"),
        F.regexp_extract(name, p, 1).cast("int").alias("year"),
        e.alias("e_km"),
        n.alias("n_km"),
        F.regexp_extract(name, p, 4).alias("resolution"),
        F.concat_ws("-", e.cast("string"), n.cast("string")).alias("tile_id"),
    ))
