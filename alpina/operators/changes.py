"""Change detection of a source listing against a ledger / manifest, and key-based removal.

Each is one distributed join (listing ⋈ aggregated ledger) instead of a driver-side dict.
The ledger is aggregated to one row per file first, so the join side is bounded by the
number of distinct files; Catalyst/AQE choose broadcast or sort-merge from its real size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _last_per_file(ledger: DataFrame, id_col: str, mod_col: str, target: str | None,
                   as_epoch: bool) -> DataFrame:
    if target is not None:
        ledger = ledger.where(F.col("target_table") == F.lit(target))
    m = F.unix_seconds(F.max(F.col(mod_col).cast("timestamp"))) if as_epoch else F.max(mod_col)
    return ledger.groupBy(F.col(id_col).alias("_lid")).agg(m.alias("_last"))


def changed_by_time(listing: DataFrame, ledger: DataFrame, *, id_col: str = "file_id",
                    modified_col: str = "modified_time", ledger_id: str = "file_id",
                    ledger_modified: str = "modified_time", target: str | None = None) -> DataFrame:
    """Listing rows that are new (id not in ledger) or whose modification text is greater than
    the greatest logged one for the same id. Compared as **text**, like the source API's ISO
    strings."""
    last = _last_per_file(ledger, ledger_id, ledger_modified, target, as_epoch=False)
    j = listing.join(last, listing[id_col] == last["_lid"], "left")
    keep = F.col("_lid").isNull() | (F.col(modified_col).cast("string") > F.col("_last").cast("string"))
    return j.where(keep).drop("_lid", "_last")


def changed_by_epoch(listing: DataFrame, ledger: DataFrame, *, id_col: str = "file_id",
                     modified_col: str = "modified_time", name_col: str = "file_name",
                     ledger_id: str = "file_id", ledger_modified: str = "modified_time",
                     target: str | None = None) -> DataFrame:
    """As :func:`changed_by_time` but on whole epoch seconds (sub-second changes are not seen),
    ordered by name."""
    last = _last_per_file(ledger, ledger_id, ledger_modified, target, as_epoch=True)
    j = listing.join(last, listing[id_col] == last["_lid"], "left")
    sec = F.floor(F.unix_micros(F.col(modified_col).cast("timestamp")) / F.lit(1_000_000))
    keep = F.col("_lid").isNull() | F.col("_last").isNull() | (sec > F.col("_last"))
    return j.where(keep).drop("_lid", "_last").orderBy(name_col, id_col)


def changed_by_checksum(assets: DataFrame, manifest: DataFrame, *, path_col: str = "path",
                        checksum_col: str = "checksum", manifest_path: str = "path",
                        manifest_checksum: str = "checksum", force: bool = False) -> DataFrame:
    """Assets to load: forced, or without checksum, or with a checksum different from the one
    recorded for the same path."""
    known = manifest.select(F.col(manifest_path).alias("_mp"), F.col(manifest_checksum).alias("_known"))
    j = assets.join(known, assets[path_col] == known["_mp"], "left")
    ck = F.col(checksum_col)
    skip = F.lit(not force) & ck.isNotNull() & F.coalesce(ck == F.col("_known"), F.lit(False))
    return j.where(~skip).drop("_mp", "_known")


def changed_by_size_time(source: DataFrame, stored: DataFrame, *, name_col: str = "name",
                         size_col: str = "size", mtime_col: str = "modified",
                         stored_name: str = "name", stored_size: str = "source_size",
                         stored_mtime: str = "source_modified", force: bool = False) -> DataFrame:
    """Files to copy: skipped only when a stored copy exists with the same size and a stored
    source time at or after the source's time."""
    if force:
        return source
    st = stored.select(F.col(stored_name).alias("_sn"), F.col(stored_size).cast("string").alias("_ss"),
                       F.col(stored_mtime).alias("_sm"))
    # an anti join: a name stored twice cannot multiply source rows
    return source.join(st, (source[name_col] == st["_sn"]) & (source[size_col].cast("string") == st["_ss"])
                       & (st["_sm"] >= source[mtime_col]), "left_anti")


def missing_by_name(selected: DataFrame, existing: DataFrame, *, name_col: str = "name",
                    existing_name: str | None = None, limit: int | None = None,
                    order: list | None = None) -> DataFrame:
    """Selected rows whose name is not yet present; optional limit applied **after** the
    difference, in a total order."""
    ex = existing.select(F.col(existing_name or name_col).alias("_en")).distinct()
    out = selected.join(ex, selected[name_col] == ex["_en"], "left_anti")
    if limit:
        out = out.orderBy(*(order or [name_col])).limit(limit)
    return out


def delete_semi(table: DataFrame, batch: DataFrame, *, id_col: str, batch_id: str | None = None) -> DataFrame:
    """Rows of ``table`` whose id is **not** in the batch (the kept side of a delete). Lazy: Spark
    picks the join from the measured size of the batch's ids."""
    ids = batch.select(F.col(batch_id or id_col).alias("_bid")).distinct()
    return table.join(ids, table[id_col] == ids["_bid"], "left_anti")
