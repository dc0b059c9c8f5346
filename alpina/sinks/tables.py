"""Parquet-path table maintenance without a transactional format.

Rules used throughout: never overwrite a path that the same plan reads (stage first);
add a batch as a folder of its own that a marker file completes, and resolve the newest per key on
reading; make every write idempotent under replay.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.session import delete_path, hadoop_fs, list_dir, path_exists, write_text_file


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; new columns are allowed (old files simply lack them)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read with schema merging: union of all columns, absent ones NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def rename_path(spark: SparkSession, src: str, dst: str) -> None:
    fs, s = hadoop_fs(spark, src)
    _, d = hadoop_fs(spark, dst)
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    if not fs.rename(s, d):
        raise IOError(f"rename {src} -> {dst} failed")


def recover_table(spark: SparkSession, path: str) -> bool:
    """If an overwrite died between its two renames, the table folder is missing and its previous
    version sits next to it as ``<path>.__old_*``: put the newest one back. Returns True if
    something was restored."""
    base = path.rstrip("/")
    if path_exists(spark, base):
        return False
    parent, name = base.rsplit("/", 1)
    olds = sorted(n for n in list_dir(spark, parent) if n.startswith(name + ".__old_"))
    if not olds:
        return False
    fs, _ = hadoop_fs(spark, base)
    newest = max(olds, key=lambda n: hadoop_fs(spark, f"{parent}/{n}")[0]
                 .getFileStatus(hadoop_fs(spark, f"{parent}/{n}")[1]).getModificationTime())
    rename_path(spark, f"{parent}/{newest}", base)
    return True


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Full rebuild (schema may change), staged so the source may be the table itself.
    Swap = rename old away, rename stage in, delete old; :func:`recover_table` repairs a swap
    interrupted between the renames. Returns the written row count (from the written files)."""
    spark = df.sparkSession
    recover_table(spark, path)
    stage = f"{path.rstrip('/')}.__stage_{uuid.uuid4().hex[:8]}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(stage)
    old = f"{path.rstrip('/')}.__old_{uuid.uuid4().hex[:8]}"
    if path_exists(spark, path):
        rename_path(spark, path, old)
    rename_path(spark, stage, path)
    delete_path(spark, old)
    return spark.read.parquet(path).count()


DONE = "_DONE"
FOLD_AFTER = 20


def _batches(spark: SparkSession, path: str, done: bool = True) -> list[int]:
    base = path.rstrip("/")
    found = (n for n in list_dir(spark, base) if n.startswith("batch="))
    return sorted(int(n.split("=", 1)[1]) for n in found if path_exists(spark, f"{base}/{n}/{DONE}") == done)


def replace_by_key(batch: DataFrame, path: str, id_col: str, ids: DataFrame | None = None,
                   fold_after: int = FOLD_AFTER) -> int:
    """Idempotent replacement: rows whose source id is in ``ids`` (default: the ids occurring
    in the batch) are replaced by the batch's rows of that id.

    ``ids`` may name sources that now yield no rows at all (a re-processed file whose cells are
    all no-data); their old rows disappear too. A batch is a folder of its own with its rows and the ids it
    replaces; a marker file, written last, makes it part of the table. Nothing that exists is rewritten or deleted
    to add it, so the cost follows the batch and a crash at any point leaves the table as it was.
    :func:`read_replaced` resolves the newest batch per id. After ``fold_after`` batches they are folded into one.
    Returns the batch number."""
    spark, base = batch.sparkSession, path.rstrip("/")
    for left in _batches(spark, base, done=False):  # of a run that died
        delete_path(spark, f"{base}/batch={left}")
    number = max(_batches(spark, base), default=0) + 1
    folder = f"{base}/batch={number}"
    batch.write.parquet(f"{folder}/rows")
    named = spark.read.schema(batch.schema).parquet(f"{folder}/rows") if ids is None else ids
    named.select(F.col(id_col).alias("id")).distinct().write.parquet(f"{folder}/ids")
    write_text_file(spark, f"{folder}/{DONE}", "")
    if len(_batches(spark, base)) > fold_after:
        fold_batches(spark, base, id_col)
    return number


def read_replaced(spark: SparkSession, path: str, id_col: str, batch: int | None = None) -> DataFrame:
    """The table as it stands: each source id's rows from the newest batch that names it (or the rows
    of one ``batch``). Columns added by later batches are NULL in earlier ones."""
    base = path.rstrip("/")
    numbers = [batch] if batch is not None else _batches(spark, base)
    if not numbers:
        raise FileNotFoundError(f"no complete batch below {path}")
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{base}/batch={n}/rows" for n in numbers])
    if len(numbers) == 1:
        return rows
    columns = rows.columns
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/batch=(\d+)/", 1).cast("int")
    ids = spark.read.parquet(*[f"{base}/batch={n}/ids" for n in numbers]).select("id", number.alias("_batch"))
    newest = ids.groupBy("id").agg(F.max("_batch").alias("_newest"))
    numbered = rows.select("*", number.alias("_batch"))
    return (numbered.join(newest, F.col(id_col).eqNullSafe(F.col("id")) & (F.col("_batch") == F.col("_newest")), "left_semi")
            .select(*[f"`{c}`" for c in columns]))


def fold_batches(spark: SparkSession, path: str, id_col: str) -> int:
    """Rewrite the table as one batch that names every id, then drop the batches before it. Until its
    marker is written the old ones stand; after that they are superseded, deleted or not."""
    base = path.rstrip("/")
    old = _batches(spark, base)
    number = old[-1] + 1
    read_replaced(spark, base, id_col).write.mode("overwrite").parquet(f"{base}/batch={number}/rows")
    (spark.read.parquet(*[f"{base}/batch={n}/ids" for n in old]).distinct()
     .write.mode("overwrite").parquet(f"{base}/batch={number}/ids"))
    write_text_file(spark, f"{base}/batch={number}/{DONE}", "")
    for n in old:
        delete_path(spark, f"{base}/batch={n}/{DONE}")
        delete_path(spark, f"{base}/batch={n}")
    return number


def create_typed_table(spark: SparkSession, name: str, columns: Sequence[tuple[str, str, str | None]],
                       cluster_by: Sequence[str] = (), comment: str | None = None,
                       location: str | None = None) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with declared types, column comments and clustering keys."""
    cols = ",\n  ".join(
        f"`{n}` {t}" + (f" COMMENT '{c.replace(chr(39), chr(39) * 2)}'" if c else "") for n, t, c in columns)
    sql = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
    if cluster_by:
        sql += f" CLUSTER BY ({', '.join(cluster_by)})"
    if comment:
        sql += f" COMMENT '{comment.replace(chr(39), chr(39) * 2)}'"
    if location:
        sql += f" LOCATION '{location}'"
    spark.sql(sql)


def write_dated_partitions(df: DataFrame, path: str, ts_col: str, fmt: str = "json",
                           mode: str = "append", date_col: str = "date") -> None:
    """Write below ``date=YYYY-MM-DD/`` folders (NDJSON by default)."""
    out = df.withColumn(date_col, F.date_format(F.col(ts_col), "yyyy-MM-dd"))
    # rebalance on the day: few files per folder, and AQE splits a day that is much larger
    out.hint("rebalance", date_col).write.mode(mode).partitionBy(date_col).format(fmt).save(path)


_DATE_DIR = re.compile(r"date=(\d{4}-\d{2}-\d{2})")


def expire_partitions(spark: SparkSession, root: str, older_than: datetime) -> list[str]:
    """Delete ``date=YYYY-MM-DD`` folders whose date (midnight UTC) is before ``older_than``.
    Folders not matching the pattern are left alone. Returns the deleted folder names."""
    cutoff = older_than.replace(tzinfo=None)
    gone = []
    for name in sorted(list_dir(spark, root)):
        m = _DATE_DIR.fullmatch(name)
        if m and datetime.fromisoformat(m.group(1)) < cutoff:
            delete_path(spark, f"{root.rstrip('/')}/{name}")
            gone.append(name)
    return gone


def full_refresh(spark: SparkSession, target_path: str, ledger_path: str, target_name: str) -> None:
    """Drop the target and only its ledger rows (the ledger is rewritten through a stage)."""
    delete_path(spark, target_path)
    if path_exists(spark, ledger_path):
        rest = spark.read.parquet(ledger_path).where(F.col("target_table") != F.lit(target_name))
        overwrite_table(rest, ledger_path)


def materialize_view(df: DataFrame, path: str) -> int:
    """Named batch recompute: scan + full overwrite; returns the row count."""
    return overwrite_table(df, path)
