"""Tables laid out along a space-filling curve, so that a read of a bounding box skips most row groups.

The clustering columns are scaled to whole numbers between their smallest and largest finite value and their
bits are interleaved (Z-order). Rows are range-partitioned and sorted by that number: a file covers a compact
stretch of the curve, and Parquet's minimum and maximum of each row group are narrow in every column at once.

Defined results: a row with a null, NaN or infinite coordinate is kept and stands before all others; a column
with one value adds nothing to the order; rows that share one place are dealt to several files by a hash of the
row; an empty frame gives an empty table. Clustering columns must be numbers, dates or timestamps.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, NumericType, StructType, TimestampNTZType, TimestampType, VariantType

from alpina.sinks.tables import overwrite_table

CURVE_BITS = 62
ROWS_PER_FILE = 4_000_000
ROW_GROUP_BYTES = 32 << 20


def _coordinate(schema: StructType, name: str) -> Column:
    kind = schema[name].dataType
    if isinstance(kind, DateType | TimestampNTZType):
        x = F.col(f"`{name}`").cast("timestamp").cast("double")
    elif isinstance(kind, NumericType | TimestampType):
        x = F.col(f"`{name}`").cast("double")
    else:
        raise TypeError(f"cannot cluster by {name}: {kind.simpleString()}")
    return F.when(F.abs(x) < F.lit(math.inf), x)  # NaN is above infinity


def curve_position(coordinates: Sequence[Column], bounds: Sequence[tuple[float, float]]) -> Column:
    """Place on the curve of a point with the given ``(low, high)`` bounds; -1 where a coordinate is null."""
    bits = min(31, CURVE_BITS // len(coordinates))
    scaled = []
    for x, (low, high) in zip(coordinates, bounds, strict=True):
        share = (x / 2 - low / 2) / (high / 2 - low / 2) if high > low else x * 0  # halves: no overflow
        scaled.append(F.floor(share * ((1 << bits) - 1)).cast("long"))
    parts = [F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1)), b * len(scaled) + j)
             for b in range(bits) for j, c in enumerate(scaled)]
    return F.coalesce(reduce(lambda a, b: a.bitwiseOR(b), parts), F.lit(-1).cast("long"))


def along_curve(df: DataFrame, columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df`` partitioned and sorted along the curve (one pass for bounds and count, one exchange)."""
    points = [_coordinate(df.schema, c) for c in columns]
    found = df.agg(F.count(F.lit(1)).alias("n"), *[f(p).alias(f"{f.__name__}{i}") for i, p in enumerate(points)
                                                   for f in (F.min, F.max)]).first()
    bounds = [(found[f"min{i}"] or 0.0, found[f"max{i}"] or 0.0) for i in range(len(points))]
    place = "_place"
    while place in df.columns:
        place += "_"
    hashed = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, MapType | VariantType)]
    placed = df.withColumn(place, curve_position(points, bounds))
    files = max(1, -(-found["n"] // rows_per_file))
    return placed.repartitionByRange(files, place, F.xxhash64(*hashed)).sortWithinPartitions(place).drop(place)


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], *, rows_per_file: int = ROWS_PER_FILE,
                    row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """Append ``df`` to the Parquet table at ``path``, laid out along the curve. Each append is laid out for
    itself; :func:`recluster` merges them."""
    (along_curve(df, columns, rows_per_file).write.mode("append")
     .option("parquet.block.size", row_group_bytes).parquet(path))


def recluster(spark: SparkSession, path: str, columns: Sequence[str], *, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Rewrite the whole table along one curve (staged, then swapped in). Returns its number of rows."""
    return overwrite_table(along_curve(spark.read.option("mergeSchema", True).parquet(path), columns, rows_per_file), path)


def clustering_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns that ``CREATE TABLE ... CLUSTER BY`` recorded for a table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'clusteringColumns'").collect()
    return [".".join(c) for c in json.loads(rows[0]["value"])] if rows else []


def insert_clustered(df: DataFrame, name: str, *, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Insert by column name into a table, laid out by its own clustering columns. Values are cast to the declared
    types first, so the layout follows what is stored."""
    spark = df.sparkSession
    columns = clustering_columns(spark, name)
    if not columns:
        raise ValueError(f"{name} has no clustering columns")
    typed = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in spark.table(name).schema.fields])
    along_curve(typed, columns, rows_per_file).write.insertInto(name)


def in_box(df: DataFrame, box: dict[str, tuple]) -> DataFrame:
    """Rows whose columns lie between (low, high), both included: plain comparisons, which the Parquet scan
    uses to skip row groups."""
    for c, (low, high) in box.items():
        df = df.where(F.col(f"`{c}`").between(low, high))
    return df
