"""Schema-driven projections, filters, ordering and unions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.fixed_values import STATION_COLS
from alpina.functions.casts import cast_double_try


def _q(c: str) -> Column:
    return F.col("`" + c.replace("`", "``") + "`")


def project_values(df: DataFrame, keys: Sequence[str], values: Sequence[str],
                   extra: Sequence[str] = (), cast=cast_double_try) -> DataFrame:
    """Keys as they are, a fixed list of value columns cast to DOUBLE (absent ones typed NULL),
    then ``extra`` pass-through columns. A missing **key** column is an error."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key columns {missing} missing; present: {df.columns}")
    vals = [(cast(v) if v in df.columns else F.lit(None).cast("double")).alias(v) for v in values]
    return df.select(*[_q(k) for k in keys], *vals, *[_q(e) for e in extra])


def project_dynamic(df: DataFrame, technical: Iterable[str], cast=lambda c: _q(c).cast("double"),
                    lead: Sequence[Column] = (), tail: Sequence[str] = ()) -> DataFrame:
    """Every column not in ``technical`` is cast (default DOUBLE, strict); ``lead`` columns
    come first, ``tail`` pass-through columns last."""
    tech = set(technical)
    values = [cast(c).alias(c) for c in df.columns if c not in tech]
    return df.select(*lead, *values, *[_q(t) for t in tail])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep rows whose keys are all non-NULL."""
    cond = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in keys])
    return df.where(cond)


def select_assets(parsed: DataFrame, granularities: Sequence[str], periods: Sequence[str],
                  min_year: int | None, order: Sequence[str] = ("name",)) -> DataFrame:
    """Granularity in the set; period in the set **or absent**; end year ≥ min **or absent**."""
    cond = F.col("gran").isin(list(granularities))
    cond = cond & (F.col("period").isNull() | F.col("period").isin(list(periods)))
    if min_year is not None:
        cond = cond & (F.col("end_year").isNull() | (F.col("end_year") >= min_year))
    return parsed.where(cond).orderBy(*order)


def bbox_filter(df: DataFrame, bbox: Sequence[int] | None, x_col: str = "e_km", y_col: str = "n_km") -> DataFrame:
    """Inclusive bounding box ``(x_min, y_min, x_max, y_max)``; no box keeps everything."""
    if not bbox:
        return df
    x0, y0, x1, y1 = bbox
    return df.where(F.col(x_col).between(x0, x1) & F.col(y_col).between(y0, y1))


def sorted_limit(df: DataFrame, order: Sequence[str], limit: int | None) -> DataFrame:
    """Total order; ``limit`` 0/None means no limit (a top-k is the feature here)."""
    out = df.orderBy(*order)
    return out.limit(limit) if limit else out


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """First ``n`` rows in a deterministic order."""
    return df.orderBy(*order).limit(n)


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """UNION ALL by column name of N sources."""
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def station_snapshot_project(df: DataFrame, snapshot_col: str = "_ingested_at") -> DataFrame:
    """Station snapshot → silver station row: ``code`` upper-cased as ``station_code``,
    coordinates/elevation try-cast to DOUBLE, ingestion time as ``_snapshot_at``."""
    code, label, lon, lat, elevation, country, canton, kind = STATION_COLS
    return df.select(
        F.upper(F.col(code)).alias("station_code"),
        label,
        cast_double_try(lon).alias(lon),
        cast_double_try(lat).alias(lat),
        cast_double_try(elevation).alias(elevation),
        country,
        canton,
        kind,
        F.col(snapshot_col).alias("_snapshot_at"),
    )
