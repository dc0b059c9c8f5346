"""A stream of file versions: every file of a folder, again each time it is rewritten.

Spark's own file source remembers paths and never reads one twice. :class:`FileVersions` is a streaming data source whose offsets are
(modification time, path): a trigger returns the files whose pair lies beyond the last offset, so a file that was
overwritten in place comes again with its new time. The offset is two values however many files there are, and Spark's
checkpoint keeps it, so a restart goes on where the last committed batch ended.

The rows name files; what is in them is read by Spark's own readers (:func:`start_bronze`), in as many tasks as these take.

A file has to get a new modification time when it is written: one that arrives with a time before the last offset (a copy that keeps
old times) is not seen; ``ingest_flow`` and ``weather_flow`` find such files, by their ledger. Files younger than ``settleMs`` wait for the
next trigger, so that two files of one millisecond can't straddle an offset.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery

from alpina.session import list_dir, path_exists
from alpina.sources.delimited import RESCUED, read_delimited_union
from alpina.streaming.bronze import run_foreach_batch
from alpina.streaming.scd1 import checkpoint_id

FILES_A_TASK = 1000
SETTLE_MS = 1000
BATCH = "_batch"


class FilePart(InputPartition):
    def __init__(self, files: list[tuple[str, str, int, int]]):
        self.files = files


class FileVersionsReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]
        self.pattern = options.get("pattern", "*")
        self.settle = int(options.get("settlems", options.get("settleMs", SETTLE_MS)))

    def _files(self) -> list[tuple[int, str, str, int]]:
        """(modification time in ms, path, name, size) of the files, in order; hidden files and folders are left out."""
        from pyarrow import fs
        uri = self.root if ":" in self.root.split("/")[0] else "file://" + self.root
        store, top = fs.FileSystem.from_uri(uri)
        before = self.root.rstrip("/").removesuffix(top.rstrip("/"))
        latest, out = int(time.time() * 1000) - self.settle, []
        for f in store.get_file_info(fs.FileSelector(top, allow_not_found=True, recursive=True)):
            parts = f.path.removeprefix(top).strip("/").split("/")
            ms = f.mtime_ns // 1_000_000 if f.mtime_ns else 0
            if f.type == fs.FileType.File and f.size and ms <= latest and fnmatchcase(f.base_name, self.pattern) \
                    and not any(p.startswith(("_", ".")) for p in parts):
                out.append((ms, before + f.path, f.base_name, f.size))
        return sorted(out)

    def initialOffset(self) -> dict:
        return {"ms": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = self._files()
        return {"ms": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[FilePart]:
        low, high = (start["ms"], start["path"]), (end["ms"], end["path"])
        new = [(path, name, size, ms) for ms, path, name, size in self._files() if low < (ms, path) <= high]
        return [FilePart(new[i:i + FILES_A_TASK]) for i in range(0, len(new), FILES_A_TASK)] or [FilePart([])]

    def read(self, partition: FilePart) -> Iterator[tuple]:
        yield from partition.files

    def commit(self, end: dict) -> None:
        pass


class FileVersions(DataSource):
    """``spark.readStream.format("file_versions")`` after :func:`file_versions` has registered it; options ``path``,
    ``pattern`` (a glob on base names), ``settleMs``."""

    @classmethod
    def name(cls) -> str:
        return "file_versions"

    def schema(self) -> str:
        return "path string, name string, size long, modified_ms long"

    def streamReader(self, schema) -> FileVersionsReader:
        return FileVersionsReader(self.options)


def file_versions(spark: SparkSession, folder: str, pattern: str = "*", settle_ms: int = SETTLE_MS) -> DataFrame:
    """Streaming (``path``, ``name``, ``size``, ``modified``) of the files below ``folder``, one row per version."""
    spark.dataSource.register(FileVersions)
    rows = (spark.readStream.format("file_versions").option("path", folder).option("pattern", pattern)
            .option("settleMs", str(settle_ms)).load())
    return rows.select("path", "name", "size", F.timestamp_millis("modified_ms").alias("modified"))


def start_bronze(spark: SparkSession, folder: str, pattern: str, out: str, checkpoint: str, *, sep: str = ";",
                 key_col: str | None = None, lineage: tuple[str, str] = ("source_file", "source_modified_at"),
                 encoding: str | None = None, settle_ms: int = SETTLE_MS, available_now: bool = True) -> StreamingQuery:
    """Continuous ingest of delimited files into an all-STRING bronze table that keeps every version of a file.

    Columns are bound by each file's own header: a delivery may bring new columns or another order while the stream
    runs. Fields beyond a header are kept in the map column ``_rescued``. A batch is a folder of its own, named by the checkpoint
    and its number: a replayed batch writes its folder again, if it is not there whole. Files without a header line are no rows."""
    source = checkpoint_id(spark, checkpoint)

    def load(batch: DataFrame, batch_id: int) -> None:
        session, folder_ = batch.sparkSession, f"{out.rstrip('/')}/run={source}-{batch_id}"
        paths = [r["path"] for r in batch.select("path").distinct().collect()]  # the files to open
        if not paths or path_exists(session, f"{folder_}/_SUCCESS"):
            return
        rows = read_delimited_union(session, paths, sep, key_col, encoding, lineage, rescued=RESCUED)
        (rows.withColumn("_ingested_at", F.current_timestamp()).withColumn(BATCH, F.lit(batch_id).cast("long"))
         .write.mode("overwrite").parquet(folder_))

    return run_foreach_batch(file_versions(spark, folder, pattern, settle_ms), load, checkpoint, available_now=available_now)


def read_bronze(spark: SparkSession, out: str) -> DataFrame | None:
    """All versions of all rows: the union of the columns of the batches that are whole; None before the first."""
    base = out.rstrip("/")
    runs = [f"{base}/{n}" for n in sorted(list_dir(spark, base)) if n.startswith("run=") and path_exists(spark, f"{base}/{n}/_SUCCESS")]
    return spark.read.option("mergeSchema", True).parquet(*runs) if runs else None
