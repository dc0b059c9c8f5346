"""Values that must equal the source data's conventions for results to be right.

Fixed values, in natural order, kept together here; every module imports them from this file.
"""

# Timestamp formats.
WEATHER_TS_FORMAT = "dd.MM.yyyy HH:mm"
SNOW_TS_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ssX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd HH:mm:ssXXX",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
)

# File-name patterns.
# weather asset: ogd-smn_<station>_<gran>[_<period>][_<y1>-<y2>].csv
ASSET_NAME_PATTERN = (
    r"^ogd-smn_([a-z0-9]+)_([tdhmy])(?:_(historical|recent|now))?(?:_(\d{4})-(\d{4}))?\.csv$"
)
# elevation tile: swissalti3d_<year>_<E km>-<N km>_<resolution>_2056_<n>.tif
TILE_NAME_PATTERN = r"swissalti3d_(\d{4})_(\d{4})-(\d{4})_([\d.]+)_2056_\d+\.tif$"

# TIFF / BigTIFF signatures (little endian, big endian), as hex.
TIFF_MAGIC_HEX = ("49492A00", "4D4D002A", "49492B00", "4D4D002B")

# Checksum multihash prefix of sha2-256 (0x12 0x20).
SHA256_MULTIHASH_PREFIX = "1220"

# Catalog item asset fields.
ASSET_FIELDS = ("href", "file:checksum", "updated")

# Bronze lineage column names (files convention, weather convention).
LINEAGE_UNDERSCORE = ("_source_file", "_source_modified_at", "_ingested_at")
LINEAGE_PLAIN = ("source_file", "source_modified_at", "_ingested_at")

# Weather technical (non-measurement) columns and keys.
WEATHER_TECH = ("station_abbr", "reference_timestamp", "source_file", "source_modified_at",
                "_ingested_at", "_rescued_data")

# Snow measurement value columns.
MEAS_COLS = (
    "hs", "ta_30min_mean", "rh_30min_mean", "tss_30min_mean", "ts0_30min_mean",
    "ts25_30min_mean", "ts50_30min_mean", "ts100_30min_mean", "rswr_30min_mean",
    "vw_30min_mean", "vw_30min_max", "dw_30min_mean", "dw_30min_sd",
)
PRECIP_COLS = ("rr_10min_sum",)
DAILY_SNOW_COLS = ("hs", "hn_1d")
SNOW_KEYS = ("station_code", "measure_date")
STATION_COLS = ("code", "label", "lon", "lat", "elevation", "country_code", "canton_code", "type")

# Terrain thresholds.
MIN_SLOPE_FOR_ASPECT_DEG = 1.0
STEEP_BAND_DEG = (30.0, 45.0)
MIN_RESULTANT = 0.05
SLOPE_PERCENTILE = 0.9
