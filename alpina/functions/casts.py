"""Casts: strict (error on bad input, ANSI) vs try (NULL on bad input); NaN → NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cast_double_strict(c) -> Column:
    """STRING → DOUBLE; under ANSI a malformed value fails the query (weather silver)."""
    return _col(c).cast("double")


def cast_double_try(c) -> Column:
    """Any → DOUBLE through its text form; malformed values become NULL (snow silver)."""
    return _col(c).cast("string").try_cast("double")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every float/double column: NaN → NULL (Spark orders NaN above all numbers, numpy skips it)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.nanvl(F.col("`" + f.name.replace("`", "``") + "`"), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col("`" + f.name.replace("`", "``") + "`"))
    return df.select(*out)
