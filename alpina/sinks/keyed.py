"""Keyed table: the newest row per key, kept in hash buckets.

A batch of changes is reduced to its newest row per key, written as bucketed Parquet files and renamed into ``rows`` as one folder; the
table is the newest row per key over all folders. Every file belongs to one bucket (the hash of the keys), which its name says, so a read aggregates bucket by bucket
without an exchange, and a fold rewrites only buckets that have gathered many files.

Nothing that exists is changed by a write. Rows may be there twice (a replayed batch, a folded file beside those it replaces): the newest
row per key is the same. A fold writes its files first, then a record of those they replace; readers leave those out, and
``sweep`` deletes them once the record is ``keep_seconds`` old, so a reader that was planned before a fold can finish. Readers take the
records first and list files second: a file is left out only if the listing holds the one that replaces it.

The number of buckets and the columns stand in ``_spec``; columns that a batch brings are added, absent ones are NULL. Bucketed files
are written and read through a table definition over the folder that lasts only while the plan is made, so no metastore
is needed.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from alpina.operators.dedupe import latest_per_key
from alpina.session import delete_path, hadoop_fs, list_dir, path_exists, read_text_file, write_text_file
from alpina.sinks.tables import rename_path

BUCKETS = 32
FOLD_AFTER = 8  # files of a bucket
KEEP_SECONDS = 3600
_BUCKET_FILE = re.compile(r"_(\d+)(?:\.c\d+)?(?:\..*)?$")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class KeyedTable:
    """``path`` with rows by ``keys``; the row with the greatest ``sequence`` wins (ties: the other columns, descending).

    ``buckets`` counts when the table is made; later the stored number does. A bucket is read by one task, so it should hold
    what a task can: rows in total / rows a task."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sequence: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sequence = list(keys), list(sequence)
        spec = self._spec()
        if spec and spec["keys"] != self.keys:
            raise ValueError(f"{path} is keyed by {spec['keys']}, not {self.keys}")
        self.buckets = spec["buckets"] if spec else buckets

    # ------------------------------------------------------------ spec
    def _spec(self) -> dict | None:
        numbers = [int(n[:-5]) for n in list_dir(self.spark, f"{self.path}/_spec") if n.endswith(".json")]
        return json.loads(read_text_file(self.spark, f"{self.path}/_spec/{max(numbers):06d}.json")) if numbers else None

    def schema(self) -> StructType | None:
        """The table's columns; None before the first write."""
        spec = self._spec()
        return StructType.fromJson(spec["schema"]) if spec else None

    def _widened(self, batch: StructType) -> StructType:
        """The table's columns and those that ``batch`` adds, stored before any file has them."""
        known = self.schema()
        fields = {f.name: f.dataType for f in known.fields} if known else {}
        for f in batch.fields:
            if fields.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"{self.path}: column {f.name} is {fields[f.name].simpleString()}, the batch has {f.dataType.simpleString()}")
        schema = StructType([StructField(n, t) for n, t in fields.items()])
        if known is None or len(known) != len(schema):
            number = len(list_dir(self.spark, f"{self.path}/_spec")) + 1
            write_text_file(self.spark, f"{self.path}/_spec/{number:06d}.json",
                            json.dumps({"keys": self.keys, "buckets": self.buckets, "schema": schema.jsonValue()}))
        return schema

    # ------------------------------------------------------------ files
    @contextmanager
    def _defined(self, schema: StructType, folder: str) -> Iterator[str]:
        name = f"alpina_keyed_{uuid.uuid4().hex}"
        keys, quoted = ", ".join(map(_quoted, self.keys)), folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet OPTIONS (recursiveFileLookup 'true') "
                       f"CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{quoted}'")
        try:
            yield name
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def files(self) -> dict[int, list[tuple[str, int]]]:
        """(path, bytes) of the current files of every bucket; what a fold has replaced is left out."""
        gone = set(self._replaced())
        out: dict[int, list[tuple[str, int]]] = {}
        fs, top = hadoop_fs(self.spark, f"{self.path}/rows")
        found = fs.listFiles(top, True) if fs.exists(top) else None
        while found is not None and found.hasNext():
            s = found.next()
            p = s.getPath()
            name = p.getName()
            if name.endswith(".parquet") and name not in gone:
                out.setdefault(int(_BUCKET_FILE.search(name[:-8])[1]), []).append((p.toString(), s.getLen()))
        return out

    def _records(self) -> dict[str, dict]:
        base = f"{self.path}/_replaced"
        return {n: json.loads(read_text_file(self.spark, f"{base}/{n}")) for n in list_dir(self.spark, base) if n.endswith(".json")}

    def _replaced(self) -> list[str]:
        return [name for r in self._records().values() for name in r["files"]]

    def _write(self, rows: DataFrame, schema: StructType, name: str) -> None:
        """Write a folder aside and rename it to its place, so a folder in ``rows`` is whole."""
        columns = [F.col(_quoted(f.name)) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
        dealt = rows.select(*columns).repartition(self.buckets, *[F.col(_quoted(k)) for k in self.keys])  # one file a bucket
        stage = f"{self.path}/_stage/{name}-{uuid.uuid4().hex[:8]}"
        with self._defined(schema, stage) as defined:
            dealt.write.insertInto(defined)
        if path_exists(self.spark, f"{self.path}/rows/{name}"):  # another writer of the same batch was faster
            delete_path(self.spark, stage)
        else:
            rename_path(self.spark, stage, f"{self.path}/rows/{name}")

    # ------------------------------------------------------------ table
    def newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, self.keys, [F.col(_quoted(s)) for s in self.sequence], drop_null_keys=False)

    def write(self, rows: DataFrame, name: str | None = None) -> bool:
        """Add a batch. ``name`` says which: a batch that is there whole is not written again (False)."""
        name = name or uuid.uuid4().hex
        if path_exists(self.spark, f"{self.path}/rows/{name}"):
            return False
        self._write(self.newest(rows), self._widened(rows.schema), name)
        return True

    def exists(self) -> bool:
        return self._spec() is not None

    def read(self) -> DataFrame:
        """The newest row per key: one task a bucket, no exchange."""
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"no keyed table below {self.path}")
        gone = self._replaced()  # before the files are listed
        with self._defined(schema, f"{self.path}/rows") as name:
            rows = self.spark.table(name)
            if gone:  # a filter on a file's name is applied to the listing
                rows = rows.where(~F.col("_metadata.file_name").isin(gone))
            return self.newest(rows)

    def fold(self, more_than: int = 1) -> list[int]:
        """Rewrite every bucket of more than ``more_than`` files as one file; the other buckets keep theirs. Returns the buckets."""
        todo = {b: files for b, files in self.files().items() if len(files) > more_than}
        schema = self.schema()
        if not todo or schema is None:
            return []
        paths = [p for files in todo.values() for p, _ in files]
        fold = f"fold-{uuid.uuid4().hex}"
        self._write(self.newest(self.spark.read.schema(schema).parquet(*paths)), schema, fold)
        write_text_file(self.spark, f"{self.path}/_replaced/{fold}.json",
                        json.dumps({"at": time.time(), "files": [p.rsplit("/", 1)[1] for p in paths], "paths": paths}))
        return sorted(todo)

    def sweep(self, keep_seconds: float = KEEP_SECONDS) -> int:
        """Delete files whose replacement is older than ``keep_seconds``, and what writes that died left aside; returns how many."""
        n = 0
        fs, _ = hadoop_fs(self.spark, self.path)
        for left in list_dir(self.spark, f"{self.path}/_stage"):
            status = fs.getFileStatus(hadoop_fs(self.spark, f"{self.path}/_stage/{left}")[1])
            if time.time() - status.getModificationTime() / 1000 > max(keep_seconds, KEEP_SECONDS):
                delete_path(self.spark, f"{self.path}/_stage/{left}")
        for name, record in self._records().items():
            if time.time() - record["at"] < keep_seconds:
                continue
            for p in record["paths"]:
                n += delete_path(self.spark, p)
                folder = p.rsplit("/", 1)[0]
                if not any(x.endswith(".parquet") for x in list_dir(self.spark, folder)):
                    delete_path(self.spark, folder)
            delete_path(self.spark, f"{self.path}/_replaced/{name}")
        return n

    def maintain(self, fold_after: int = FOLD_AFTER, keep_seconds: float = KEEP_SECONDS) -> list[int]:
        """What a writer does between batches: sweep, and fold the buckets that have gathered many files."""
        self.sweep(keep_seconds)
        return self.fold(fold_after)
