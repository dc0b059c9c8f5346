"""Whole-file quarantine inside a stream.

Every micro-batch is parsed once; files with a corrupt record go to the error table as one row each, the rows of
the other files to the good table. Both are folders of the batch, replaced when the batch is replayed and
counted only once a marker, written last, stands beside them: a crash at any point leaves each file either whole
in one of the two tables or in none, and the restarted stream does the batch again. A bad file does not
stop the stream; after it has drained, :func:`run_quarantined` raises for the files that this run rejected.

Defined results: a file without rows is in neither table; a batch without files writes two empty folders; the file
source reads a path once, so a mended file must come under a new name (or through the file-version stream).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from alpina.operators.quality import QuarantineError, split_corrupt_files
from alpina.session import delete_path, list_dir, path_exists, write_text_file
from alpina.streaming.bronze import run_foreach_batch

DONE = "_DONE"


def store_batch(batch: DataFrame, batch_id: int, root: str, file_col: str = "_source_file",
                corrupt_col: str = "_corrupt_record") -> None:
    """Write one micro-batch below ``root/batch=<id>``; the same batch again replaces it."""
    spark, folder = batch.sparkSession, f"{root.rstrip('/')}/batch={batch_id}"
    delete_path(spark, f"{folder}/{DONE}")
    good, errors = split_corrupt_files(batch, f"{folder}/stage", file_col, corrupt_col)
    good.write.mode("overwrite").parquet(f"{folder}/good")
    errors.write.mode("overwrite").parquet(f"{folder}/errors")
    write_text_file(spark, f"{folder}/{DONE}", "")
    delete_path(spark, f"{folder}/stage")


def _whole(spark: SparkSession, root: str) -> list[int]:
    base = root.rstrip("/")
    if not path_exists(spark, base):
        return []
    numbers = sorted(int(n.split("=", 1)[1]) for n in list_dir(spark, base) if n.startswith("batch="))
    return [n for n in numbers if path_exists(spark, f"{base}/batch={n}/{DONE}")]


def read_side(spark: SparkSession, root: str, side: str, after: int = -1) -> DataFrame:
    """The ``good`` or ``errors`` table: the whole batches with an id above ``after``."""
    folders = [f"{root.rstrip('/')}/batch={n}/{side}" for n in _whole(spark, root) if n > after]
    return spark.read.parquet(*folders) if folders else spark.createDataFrame([], StructType([]))


def run_quarantined(stream: DataFrame, root: str, checkpoint: str, file_col: str = "_source_file",
                    corrupt_col: str = "_corrupt_record") -> int:
    """Drain the files that are there. Returns the number of new batches; raises
    :class:`QuarantineError` after everything is stored if this run rejected files."""
    spark = stream.sparkSession
    before = max(_whole(spark, root), default=-1)
    run_foreach_batch(stream, lambda df, i: store_batch(df, i, root, file_col, corrupt_col), checkpoint)
    new = [n for n in _whole(spark, root) if n > before]
    rejected = read_side(spark, root, "errors", before).count() if new else 0
    if rejected:
        raise QuarantineError(f"{rejected} files rejected, see {root.rstrip('/')}/batch=*/errors")
    return len(new)
