"""Delimited text sources: all columns STRING, header-drift safe union, legacy charsets."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alpina.operators.projection import union_by_name
from alpina.session import scratch_path
from alpina.sources.files import raw_path, source_path


def _paths(paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def csv_reader(spark: SparkSession, sep: str = ",", encoding: str | None = None, multi_line: bool = False):
    """The CSV reader every delimited source shares: header, no type inference (all STRING),
    RFC-4180 quoting (``""`` escapes a quote). Files are split among tasks; ``multi_line`` is for sources whose
    fields hold line breaks (then one task reads a file)."""
    r = (spark.read.option("header", True).option("inferSchema", False)
         .option("sep", sep).option("quote", '"').option("escape", '"')
         .option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if encoding:
        r = r.option("encoding", encoding)
    return r


def read_delimited(spark: SparkSession, paths, sep: str = ",", keep_empty: bool = False,
                   encoding: str | None = None, multi_line: bool = False) -> DataFrame:
    """Header CSV → every column STRING.

    ``keep_empty=True`` keeps empty fields as ``""`` (as a text-preserving reader would) instead
    of NULL."""
    df = csv_reader(spark, sep, encoding, multi_line).csv(_paths(paths))
    if keep_empty:
        df = df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])
    return df


def read_charset_csv(spark: SparkSession, paths, sep: str = ";", encoding: str = "windows-1252",
                     multi_line: bool = False) -> DataFrame:
    """CSV in a legacy single-byte charset (needs ``spark.sql.legacy.javaCharsets=true``)."""
    return csv_reader(spark, sep, encoding, multi_line).csv(_paths(paths))


def header_signatures(spark: SparkSession, paths, sep: str, key_col: str | None = None) -> dict[str, list[str]]:
    """header line → files having it (paths in ``_metadata.file_path`` form). A file's header is its
    first line: the one with the smallest ``monotonically_increasing_id`` in its first block (ids grow in read
    order, and a split is read front to back); only that line of a file leaves its task. With ``key_col``, only
    files whose first header field is the key column count."""
    first = (spark.read.text(_paths(paths)).where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("value"), F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("i"))
             .groupBy("file").agg(F.min_by("value", "i").alias("value")))
    groups: dict[str, list[str]] = {}
    for r in first.collect():
        if key_col is None or header_names(r["value"], sep)[:1] == [key_col]:
            groups.setdefault(r["value"], []).append(r["file"])
    return groups


def header_names(line: str, sep: str) -> list[str]:
    """Field names of a header line; a name that occurs again gets a number, as in ``a``, ``a.1``."""
    seen: dict[str, int] = {}
    out = []
    for name in next(csv.reader([line.lstrip("\ufeff")], delimiter=sep), []):
        k = seen.get(name, 0)
        seen[name] = k + 1
        out.append(f"{name}.{k}" if k else name)
    return out


RESCUED = "_rescued"
_NO_SEP = "\u0001\u0002\u0003"  # separates nothing: a line is one field


def _lines(spark: SparkSession, paths, header: bool, encoding: str | None) -> DataFrame:
    """Lines of delimited files as ``line``; with ``header`` each file's first line is left out."""
    r = spark.read.schema("line string").option("header", header).option("sep", _NO_SEP).option("quote", "")
    return (r.option("encoding", encoding) if encoding else r).csv(_paths(paths))


def line_fields(line: Column, sep: str) -> Column:
    """Raw fields of a line; a quoted field keeps its quotes (``""`` inside stands for one)."""
    s = re.escape(sep)
    # every match starts with a separator, so none is empty and an empty first field is found too
    return F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{s}("[^"]*+(?:""[^"]*+)*+"(?={s}|\\z)|[^{s}]*)'), F.lit(1))


def field_value(field: Column, keep_empty: bool) -> Column:
    """The text of a raw field; an empty one is NULL unless ``keep_empty`` or written as ``""``."""
    quoted = (F.length(field) >= 2) & field.startswith('"') & field.endswith('"')
    text = F.when(quoted, F.replace(F.substr(field, F.lit(2), F.length(field) - 2), F.lit('""'), F.lit('"'))).otherwise(field)
    return text if keep_empty else F.when(quoted | (field != ""), text)


def _numbered(names: Column) -> Column:
    """Names of which one that occurs again gets a number, as :func:`header_names` gives it."""
    def named(name: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda other: other == name))
        return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

    return F.transform(names, named)


def header_dictionary(spark: SparkSession, paths, sep: str, key_col: str | None = None, encoding: str | None = None) -> DataFrame:
    """(``file``, ``names``) per file, written once: its first line that isn't empty, taken apart. A file's first line is that
    with the smallest ``monotonically_increasing_id`` in its first block; only that line of a file leaves its task."""
    first = (_lines(spark, paths, False, encoding).where(F.col("_metadata.file_block_start") == 0)
             .select("line", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("i"))
             .groupBy("file").agg(F.min_by("line", "i").alias("line")))
    fields = line_fields(F.regexp_replace("line", "^\ufeff", ""), sep)
    named = first.select("file", F.transform(fields, lambda f: field_value(f, True)).alias("names"))
    if key_col is not None:
        named = named.where(F.col("names")[0] == key_col)
    path = scratch_path(spark, "headers")
    named.select("file", _numbered(F.col("names")).alias("names")).write.parquet(path)
    return spark.read.schema("file string, names array<string>").parquet(path)


def read_delimited_union(spark: SparkSession, paths, sep: str, key_col: str | None = None,
                         encoding: str | None = None, lineage: tuple[str, str] | None = None,
                         multi_line: bool = False, keep_empty: bool = False, rescued: str | None = None) -> DataFrame:
    """Files with **different headers** → union of their columns by name, absent = NULL.

    One plan whatever the number of headers: a dictionary holds for every file where each output column stands in its
    lines; lines are joined to it by file, and a column is the field at its place. Fields beyond a file's header go into
    the map column ``rescued`` (``_c5`` is the sixth field), NULL where there are none; without ``rescued`` they are
    dropped. ``lineage`` names the (source file, modification time) columns to attach. With ``multi_line`` (fields that
    hold line breaks) lines cannot be taken apart one by one: then one read per distinct header is made."""
    if multi_line or len(sep) > 1:
        return _union_of_reads(spark, paths, sep, key_col, encoding, lineage, multi_line, keep_empty, rescued)
    headers = header_dictionary(spark, paths, sep, key_col, encoding)
    # the output's columns: in the order of the place they first stand at in any header
    columns = [r["name"] for r in headers.select(F.posexplode("names").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
               .orderBy("at", "name").collect()]
    if not columns:
        raise ValueError(f"no header found under {paths} (key column {key_col!r})")
    if key_col is not None:
        columns = [key_col, *[c for c in columns if c != key_col]]
    order = F.array(*[F.lit(c) for c in columns])
    places = headers.select("file", F.size("names").alias("n"), F.transform(order, lambda c: F.array_position("names", c).cast("int")).alias("at"))
    lines = _lines(spark, paths, True, encoding).select(
        "line", F.col("_metadata.file_path").alias("file"), source_path().alias("source"),
        F.col("_metadata.file_modification_time").alias("modified"))
    fields = lines.join(places, "file").select("n", "at", "source", "modified", line_fields(F.col("line"), sep).alias("fields"))
    bound = fields.select("n", "at", "source", "modified", F.transform("fields", lambda f: field_value(f, keep_empty)).alias("vals"),
                          *([_surplus(F.col("fields"), F.col("n")).alias("surplus")] if rescued else []))
    out = [f"get(vals, at[{i}] - 1) AS {_quoted(c)}" for i, c in enumerate(columns)]
    if rescued:
        out.append(f"surplus AS {_quoted(rescued)}")
    if lineage:
        out += [f"source AS {_quoted(lineage[0])}", f"modified AS {_quoted(lineage[1])}"]
    return bound.selectExpr(*out)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _surplus(fields: Column, n: Column) -> Column:
    """Map of the fields beyond the first ``n``, NULL where there are none."""
    pairs = F.transform(F.slice(fields, n + 1, F.size(fields)),
                        lambda f, i: F.struct(F.concat(F.lit("_c"), (n + i).cast("string")), field_value(f, True)))
    return F.when(F.size(fields) > n, F.map_from_entries(pairs))


def _union_of_reads(spark: SparkSession, paths, sep: str, key_col: str | None, encoding: str | None, lineage: tuple[str, str] | None,
                    multi_line: bool, keep_empty: bool, rescued: str | None) -> DataFrame:
    """One read per distinct header, bound by position, unioned by name. Only the first field beyond a header can be kept."""
    groups = header_signatures(spark, paths, sep, key_col)
    if not groups:
        raise ValueError(f"no header found under {paths} (key column {key_col!r})")
    frames = []
    for line, files in sorted(groups.items()):
        names = header_names(line, sep)
        df = frame_of_header(spark, names, files, sep, encoding, multi_line, keep_empty, lineage, surplus=rescued)
        if rescued:
            df = df.withColumn(rescued, F.when(F.col(rescued).isNotNull(), F.create_map(F.lit(f"_c{len(names)}"), rescued)))
        frames.append(df)
    return union_by_name(frames, allow_missing=True)


def frame_of_header(spark: SparkSession, names: list[str], files: list[str], sep: str, encoding: str | None,
               multi_line: bool, keep_empty: bool, lineage: tuple[str, str] | None, surplus: str | None = None) -> DataFrame:
    """Files with one header. With ``keep_empty`` an empty field is ``""``; a field that its line lacks is NULL
    (in such short lines empty fields are NULL too). ``surplus`` names a column for the first field beyond the
    header."""
    fields = [StructField(f"c{i}", StringType()) for i in range(len(names))]
    # a line with more or fewer fields than the header is kept as text in _odd
    reader = csv_reader(spark, sep, encoding, multi_line).schema(StructType([*fields, StructField("_odd", StringType())]))
    df = reader.option("columnNameOfCorruptRecord", "_odd").csv([raw_path(f) for f in sorted(files)])
    whole = F.col("_odd").isNull()
    picked = [(F.when(whole, F.coalesce(f"c{i}", F.lit(""))).otherwise(F.col(f"c{i}")) if keep_empty else F.col(f"c{i}")).alias(n)
              for i, n in enumerate(names)]
    if surplus:
        wider = ", ".join(f"c{i} string" for i in range(len(names) + 1))
        odd = F.from_csv("_odd", F.lit(wider), {"sep": sep, "quote": '"', "escape": '"'})
        picked.append(F.when(~whole, odd[f"c{len(names)}"]).alias(surplus))
    if lineage:  # file metadata is only resolvable on each scan, before the union
        picked += [source_path().alias(lineage[0]), F.col("_metadata.file_modification_time").alias(lineage[1])]
    return df.select(*picked)


def write_delimited(df: DataFrame, path: str, sep: str = ",", encoding: str | None = None,
                    mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """CSV writer matching :func:`csv_reader` (header, ``""`` quote escaping)."""
    w = (df.write.mode(mode).option("header", True).option("sep", sep)
         .option("quote", '"').option("escape", '"').option("emptyValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if encoding:
        w = w.option("encoding", encoding)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
