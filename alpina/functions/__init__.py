"""Column-level functions (pure ``Column`` → ``Column``); usable on batch and streaming frames."""

from alpina.functions.names import clean_column_name, clean_columns
from alpina.functions.casts import cast_double_strict, cast_double_try, nan_to_null
from alpina.functions.timeparse import (
    SNOW_TS_FORMATS, WEATHER_TS_FORMAT, parse_http_date, parse_ts_multi, parse_ts_strict,
)
from alpina.functions.text import normalize_key, parse_asset_name, parse_tile_name
from alpina.functions.checks import sniff_magic, verify_checksum
from alpina.functions.geo import grid_cell, slope_aspect

__all__ = [
    "clean_column_name", "clean_columns", "cast_double_strict", "cast_double_try", "nan_to_null",
    "SNOW_TS_FORMATS", "WEATHER_TS_FORMAT", "parse_http_date", "parse_ts_multi", "parse_ts_strict",
    "normalize_key", "parse_asset_name", "parse_tile_name", "sniff_magic", "verify_checksum",
    "grid_cell", "slope_aspect",
]
