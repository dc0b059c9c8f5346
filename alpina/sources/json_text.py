"""JSON sources and sinks that keep raw text: every top-level field STRING, nested values as
compact JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alpina.sources.files import raw_path, source_path


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def array_files(spark: SparkSession, paths: list[str]) -> tuple[list[str], list[str]]:
    """(files that hold a JSON array, the others), decided for each file by its first character
    that isn't white space. One character per file is compared and brought to the driver, which
    holds the file index anyway. Paths are in ``_metadata.file_path`` form."""
    text = F.regexp_replace("value", r"^[\s\ufeff]+", "")
    first = (spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file"), F.substring(text, 1, 1).alias("c"),
                     F.monotonically_increasing_id().alias("i")).where("c <> ''")
             .groupBy("file").agg(F.min_by("c", "i").alias("c")))
    kinds = {r["file"]: r["c"] for r in first.collect()}
    return sorted(f for f, c in kinds.items() if c == "["), sorted(f for f, c in kinds.items() if c != "[")


def json_string_schema(spark: SparkSession, paths, multi_line: bool = False,
                       corrupt_col: str | None = None) -> StructType:
    """Pass 1: the union of top-level keys, each typed STRING (key order as inferred)."""
    names = spark.read.option("multiLine", multi_line).option("primitivesAsString", True) \
        .json(_paths(paths)).columns
    fields = [StructField(n, StringType()) for n in names if n != "_corrupt_record"]
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType()))
    return StructType(fields)


def read_json_strings(spark: SparkSession, paths, multi_line: bool | None = None,
                      corrupt_col: str | None = None, keys: list[str] | None = None,
                      lineage: tuple[str, str] | None = None) -> DataFrame:
    """JSON array **or** NDJSON, decided per file → all STRING columns; nested values kept as JSON text.

    Pass 1 finds the union of top-level keys (skipped when ``keys`` is given, e.g. from the
    bronze table's current schema). Pass 2 reads with an all-STRING schema: Spark hands a
    STRING field the raw source text of nested values and of scalars (``true``, ``1.50``). The file's path and
    modification time are added when ``lineage`` names the two columns."""
    p = _paths(paths)
    arrays, lines = array_files(spark, p) if multi_line is None else (p, p)
    groups = {multi_line: p} if multi_line is not None else {True: [*map(raw_path, arrays)], False: [*map(raw_path, lines)]}
    groups = {ml: files for ml, files in groups.items() if files} or {False: p}
    if keys is None:
        found = [json_string_schema(spark, files, ml).fieldNames() for ml, files in groups.items()]
        keys = list(dict.fromkeys(k for names in found for k in names))
    fields = [StructField(k, StringType()) for k in keys if k != corrupt_col]
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType()))
    frames = []
    for ml, files in groups.items():
        r = spark.read.schema(StructType(fields)).option("multiLine", ml).option("mode", "PERMISSIVE")
        if corrupt_col:
            r = r.option("columnNameOfCorruptRecord", corrupt_col)
        df = r.json(files)
        if lineage:  # file metadata is only resolvable on each scan, before the union
            df = df.select("*", source_path().alias(lineage[0]),
                           F.col("_metadata.file_modification_time").alias(lineage[1]))
        frames.append(df)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def to_json_lines(df: DataFrame, col_name: str = "json") -> DataFrame:
    """One JSON text per record (non-ASCII kept as is)."""
    return df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(col_name))
