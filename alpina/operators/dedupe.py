"""Latest row per key, first row per name, latest value per file.

All of these are aggregations (``max_by``/``min_by`` over a struct), not windows: Spark
combines map-side before the shuffle, so a key holding a third of all rows is reduced to one
row per map task before it moves, instead of being sorted whole inside one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _named(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence, biggest: bool,
          tiebreak: Sequence | None) -> DataFrame:
    """One ``max``/``min`` over a single struct ``(order…, tiebreak…, row…)``: each column is
    carried once (a ``max_by(row, rank)`` buffer would hold the row twice when the rank is the
    row), halving what the partial aggregates shuffle. The trailing row fields also make the
    pick deterministic on ties."""
    cols = df.columns
    rest = [c for c in cols if c not in keys]
    fields = [_c(o).alias(f"_o{i}") for i, o in enumerate(order)]
    fields += [_c(t).alias(f"_t{i}") for i, t in enumerate(tiebreak or [])]
    fields += [_named(c).alias(f"_p{i}") for i, c in enumerate(rest)]
    pick = (F.max if biggest else F.min)(F.struct(*fields))
    out = df.groupBy(*[_named(k) for k in keys]).agg(pick.alias("_w"))
    pos = {c: i for i, c in enumerate(rest)}
    return out.select(*[_named(c) if c in keys else F.col("_w").getField(f"_p{pos[c]}").alias(c)
                        for c in cols])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, *,
                   tiebreak: Sequence | None = None, drop_null_keys: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (descending, NULLs lose).

    Rows with a NULL key are removed first (``drop_null_keys``). Ties on ``order`` are broken by
    ``tiebreak``, then by the other columns in table order, all descending, so the result is
    deterministic."""
    if drop_null_keys:
        cond = F.lit(True)
        for k in keys:
            cond = cond & _named(k).isNotNull()
        df = df.where(cond)
    return _pick(df, keys, order, True, tiebreak)


def latest_snapshot(df: DataFrame, keys: Sequence[str], order: Sequence, *,
                    tiebreak: Sequence | None = None) -> DataFrame:
    """As :func:`latest_per_key` but NULL keys form their own group (no filter)."""
    return _pick(df, keys, order, True, tiebreak)


def distinct_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the smallest ordinal (first occurrence)."""
    return _pick(df, keys, [ordinal], False, [])


def max_by_key(df: DataFrame, key: str, value: str, alias: str | None = None,
               where: Column | None = None) -> DataFrame:
    """``max(value)`` per key, optionally on a filtered subset (e.g. one target table)."""
    if where is not None:
        df = df.where(where)
    return df.groupBy(key).agg(F.max(value).alias(alias or value))
