"""File-system sources: typed parquet, listings, binary content, lineage, optional tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.operators.projection import union_by_name
from alpina.session import hadoop_fs, scratch_path


def read_parquet_typed(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                       where: Column | str | None = None) -> DataFrame:
    """Parquet with its own types; projection and filter reach the scan (ReadSchema /
    PushedFilters)."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def raw_path(uri: str) -> str:
    """The path a reader takes for a ``_metadata.file_path`` (which is percent-encoded)."""
    return unquote(uri)


def source_path() -> Column:
    """``_metadata.file_path`` in the one form that listings use too (``file:/x``, never ``file:///x``)."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")


LISTED = "folder boolean, path string, uri string, name string, size long, ms long"
FOLDERS_A_TASK = 16
_ESCAPED = re.compile("[\\x00-\\x7f]")
_PLAIN = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-!.~'()*,;:$&+=@/")


def _uri(path: str) -> str:
    """A path as Hadoop writes it in a URI: ASCII characters outside the plain ones are percent-encoded."""
    return _ESCAPED.sub(lambda m: m[0] if m[0] in _PLAIN else f"%{ord(m[0]):02X}", path)


def _store(root: str):
    """(file system, path in it, what comes before the path in a URI) of a folder; ValueError for unknown schemes."""
    from pyarrow import fs
    store, top = fs.FileSystem.from_uri(root if ":" in root.split("/")[0] else f"file://{root}")
    top = top.rstrip("/")
    before = "file:" if isinstance(store, fs.LocalFileSystem) else root.rstrip("/").removesuffix(top)
    return store, top, before


def _list_folders(root: str):
    """Entries of the given folders; hidden ones (``_`` or ``.`` first) are left out."""
    def run(batches):
        from pyarrow import fs
        store, _, before = _store(root)
        for batch in batches:
            rows = []
            for folder in batch["path"]:
                for f in store.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                    if not f.base_name.startswith(("_", ".")):
                        rows.append((f.type == fs.FileType.Directory, f.path, before + _uri(f.path), f.base_name, f.size or 0,
                                     (f.mtime_ns or 0) // 1_000_000))
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=[x.split()[0] for x in LISTED.split(", ")])
                        rows = []
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in LISTED.split(", ")])

    return run


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Recursive listing → (path, name, size, modified), filtered by a glob on the base name; empty
    files included. ``path`` is percent-encoded, as :func:`source_path` names a row's file.

    Folders are listed in tasks, one level of the tree after the other; what they hold is written in the shared scratch
    folder and stays a table, so the driver holds no file names. File systems that only Spark's own client can open
    are listed through that client, on the driver."""
    try:
        _, top, _ = _store(root)
    except ValueError:
        return _list_by_client(spark, root, pattern)
    out, level, n, depth = scratch_path(spark, "listing"), spark.createDataFrame([(top,)], "path string"), 1, 0
    while n:
        tasks = -(-n // FOLDERS_A_TASK)
        dealt = level.repartition(tasks, "path") if tasks > 1 else level.coalesce(1)
        dealt.mapInPandas(_list_folders(root), LISTED).write.parquet(f"{out}/level={depth}")
        level = spark.read.schema(LISTED).parquet(f"{out}/level={depth}").where("folder").select("path")
        n, depth = level.count(), depth + 1
    found = spark.read.schema(f"{LISTED}, level int").parquet(out).where("NOT folder")
    return (found.where(F.col("name").rlike(glob_regex(pattern)))
            .select(F.col("uri").alias("path"), "name", "size", F.timestamp_millis("ms").alias("modified")))


def glob_regex(pattern: str) -> str:
    """A shell glob (``*``, ``?``, ``[abc]``, ``{a,b}``) as a regular expression for the whole name."""
    out, i, depth = "", 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[" and "]" in pattern[i + 2:]:
            end = pattern.index("]", i + 2)
            body = pattern[i + 1:end]
            negated = body[:1] in "!^"
            out += "[" + ("^" if negated else "") + body[negated:].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&") + "]"
            i = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += {"*": ".*", "?": "."}.get(c) or re.escape(c)
        i += 1
    return f"(?s)\\A{out}\\z"


def _list_by_client(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    fs, top = hadoop_fs(spark, root)
    rows, jvm = [], spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.GlobPattern(pattern)
    if fs.exists(top):
        found = fs.listFiles(top, True)
        while found.hasNext():
            s = found.next()
            parts = s.getPath().toUri().getPath()[len(fs.makeQualified(top).toUri().getPath()):].split("/")
            if glob.matches(s.getPath().getName()) and not any(x.startswith(("_", ".")) for x in parts):
                rows.append((re.sub("^file:/+", "file:/", s.getPath().toUri().toString()), s.getPath().getName(), s.getLen(), s.getModificationTime()))
    df = spark.createDataFrame(rows, "path string, name string, size long, ms long")
    return df.select("path", "name", "size", F.timestamp_millis("ms").alias("modified"))


def read_binary(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, name, size, modified, content) — for checksum / magic-byte checks."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
          .option("pathGlobFilter", pattern).load(root))
    return df.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
                     "content")


from alpina.fixed_values import LINEAGE_PLAIN, LINEAGE_UNDERSCORE  # noqa: E402,F401


def with_lineage(df: DataFrame, names: Sequence[str] = LINEAGE_UNDERSCORE) -> DataFrame:
    """Source path, source modification time and ingestion time, from the file metadata of a
    file-based DataFrame (works on batch and streaming scans)."""
    f, m, i = names
    return df.select("*",
                     F.col("_metadata.file_path").alias(f),
                     F.col("_metadata.file_modification_time").alias(m),
                     F.current_timestamp().alias(i))


def read_existing(spark: SparkSession, names: Sequence[str], allow_missing_columns: bool = True) -> DataFrame | None:
    """Union by name of the tables/views that exist; missing ones are skipped; None if none."""
    frames = [spark.table(n) for n in names if spark.catalog.tableExists(n)]
    if not frames:
        return None
    return union_by_name(frames, allow_missing=allow_missing_columns)
