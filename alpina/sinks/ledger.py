"""Ingestion ledger and checksum manifest as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

# One superset schema for both ledger conventions (files with a text modification time,
# tiles with a timestamp); ``modified_time`` keeps the source's ISO text.
LEDGER_SCHEMA = StructType([
    StructField("file_id", StringType()),
    StructField("file_path", StringType()),
    StructField("file_name", StringType()),
    StructField("modified_time", StringType()),
    StructField("target_table", StringType()),
    StructField("row_count", LongType()),
    StructField("ingested_at", TimestampType()),
])


def ledger_rows(listing: DataFrame, loaded: DataFrame, target: str, *, id_col: str = "file_id",
                path_col: str = "file_path", name_col: str = "file_name",
                modified_col: str = "modified_time", loaded_file_col: str = "_source_file_id") -> DataFrame:
    """One ledger row per processed file — including files that yielded 0 rows — with the
    count of rows loaded from it. Counting is a grouped aggregate (map-side combined); the
    listing is the preserved side of the join."""
    counts = loaded.groupBy(F.col(loaded_file_col).alias("_fid")).agg(F.count(F.lit(1)).alias("_n"))
    j = listing.join(counts, listing[id_col] == counts["_fid"], "left")
    return j.select(
        F.col(id_col).cast("string").alias("file_id"),
        F.col(path_col).cast("string").alias("file_path"),
        F.col(name_col).cast("string").alias("file_name"),
        F.col(modified_col).cast("string").alias("modified_time"),
        F.lit(target).alias("target_table"),
        F.coalesce(F.col("_n"), F.lit(0)).cast("long").alias("row_count"),
        F.current_timestamp().alias("ingested_at"),
    )


def record_ledger(rows: DataFrame, ledger_path: str) -> None:
    """Append ledger rows (after the data writes: a crash before this repeats the load,
    which replace-by-key makes harmless)."""
    rows.select(*[F.col(f.name).cast(f.dataType) for f in LEDGER_SCHEMA.fields]) \
        .write.mode("append").parquet(ledger_path)


def merge_manifest(old: DataFrame, new: DataFrame, key: str = "path", record: str = "record") -> DataFrame:
    """Map upsert: a new record replaces the old one for the same key, others are kept.
    Whole records (structs) are chosen, never mixed field by field."""
    o = old.select(F.col(key).alias("_k"), F.col(record).alias("_old"))
    n = new.select(F.col(key).alias("_k"), F.col(record).alias("_new"), F.lit(True).alias("_in_new"))
    j = o.join(n, "_k", "full_outer")
    return j.select(F.col("_k").alias(key),
                    F.when(F.col("_in_new"), F.col("_new")).otherwise(F.col("_old")).alias(record))
