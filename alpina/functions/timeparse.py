"""Timestamp parsing: one strict pattern, first-of-many, and HTTP dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from alpina.fixed_values import SNOW_TS_FORMATS, WEATHER_TS_FORMAT  # noqa: E402


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts_strict(c, fmt: str = WEATHER_TS_FORMAT) -> Column:
    """One pattern; a non-matching value fails the query under ANSI."""
    return F.to_timestamp(_col(c), fmt)


def parse_ts_multi(c, formats=SNOW_TS_FORMATS) -> Column:
    """First pattern that parses, else NULL."""
    s = _col(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats])


def parse_http_date(c) -> Column:
    """RFC 1123 date (``Sun, 06 Nov 1994 08:49:37 GMT``) → timestamp.

    Spark 3+ patterns cannot parse the day name (``EEE``), so it is stripped first."""
    s = F.regexp_replace(F.trim(_col(c)), r"^[A-Za-z]{3},\s*", "")
    return F.try_to_timestamp(s, F.lit("dd MMM yyyy HH:mm:ss z"))
