"""Column-name cleaning for raw (bronze) tables."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame

from alpina.operators.quality import NameCollision

KEPT = frozenset(string.ascii_lowercase + string.digits + "_")
UNNAMED = "_unnamed"


def clean_column_name(name: str) -> str:
    """Lower case without outer white space; only letters a-z, digits and ``_`` stay, all else turns
    into ``_``. A name of nothing becomes ``_unnamed``."""
    letters = [c if c in KEPT else "_" for c in str(name).lower().strip()]
    return "".join(letters) if letters else UNNAMED


def clean_names(names: list[str]) -> list[str]:
    """Cleaned names of a header; raises when two of them collide (a sink would fail later)."""
    new = [clean_column_name(c) for c in names]
    first: dict[str, str] = {}
    for old, n in zip(names, new, strict=True):
        if n in first:
            raise NameCollision(f"cleaned column names collide: {first[n]!r} and {old!r} both become {n!r}")
        first[n] = old
    return new


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename all columns by :func:`clean_column_name`; raises early when two names collide."""
    return df.toDF(*clean_names(df.columns))
