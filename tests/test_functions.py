"""Column functions: parsing accept tables, strict vs try casts, names, checksums."""

import pytest
from pyspark.sql import functions as F

from alpina.functions.casts import cast_double_strict, cast_double_try
from alpina.functions.checks import sniff_magic, verify_checksum
from alpina.functions.names import clean_column_name, clean_columns
from alpina.functions.text import parse_asset_name, parse_tile_name
from alpina.functions.timeparse import parse_http_date, parse_ts_multi, parse_ts_strict

ACCEPT = [
    ("2025-01-02T10:00:00Z", "2025-01-02 10:00:00"),
    ("2025-01-02T10:00:00+01", "2025-01-02 09:00:00"),
    ("2025-01-02T10:00:00.123Z", "2025-01-02 10:00:00.123"),
    ("2025-01-02 10:00:00+02:00", "2025-01-02 08:00:00"),
    ("2025-01-02 10:00:00", "2025-01-02 10:00:00"),
    ("2025-01-02", "2025-01-02 00:00:00"),
    ("2025-01-02T10:00:00+00:00", None),
    ("2025-01-02T10:00Z", None),
    ("2025-01-02T10:00:00", None),
    ("02.01.2025 10:00", None),
    ("garbage", None),
]


def test_parse_ts_multi_accept_table(spark):
    df = spark.createDataFrame([(a,) for a, _ in ACCEPT], "raw string")
    got = {r["raw"]: r["ts"] for r in df.select(
        "raw", F.date_format(parse_ts_multi("raw"), "yyyy-MM-dd HH:mm:ss.SSS").alias("ts")).collect()}
    for raw, exp in ACCEPT:
        if exp is None:
            assert got[raw] is None, raw
        else:
            assert got[raw].rstrip("0").rstrip(".") == exp.rstrip("0").rstrip(".") or got[raw].startswith(exp), raw


def test_strict_parse_and_cast_raise_under_ansi(spark):
    df = spark.createDataFrame([("xx",)], "raw string")
    with pytest.raises(Exception):
        df.select(parse_ts_strict("raw")).collect()
    with pytest.raises(Exception):
        df.select(cast_double_strict("raw")).collect()
    assert df.select(cast_double_try("raw").alias("v")).first()["v"] is None


def test_http_date(spark):
    df = spark.createDataFrame([("Sun, 06 Nov 1994 08:49:37 GMT",)], "raw string")
    assert str(df.select(parse_http_date("raw").alias("t")).first()["t"]) == "1994-11-06 08:49:37"


def test_clean_column_names():
    assert clean_column_name(" Höhe [m] ") == "h_he__m_"
    assert clean_column_name("   ") == "_unnamed"


def test_clean_columns_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, a_b int")
    with pytest.raises(ValueError, match="collide"):
        clean_columns(df)


def test_checksum_and_magic(spark):
    import hashlib
    data = b"II*\x00rest"
    good = "1220" + hashlib.sha256(data).hexdigest()
    df = spark.createDataFrame([(bytearray(data), good), (bytearray(data), "1220" + "0" * 64),
                                (bytearray(data), None), (bytearray(b"GIF89a"), "1b20ab")],
                               "content binary, ck string")
    got = [(r["ok"], r["magic"]) for r in df.select(verify_checksum("content", "ck").alias("ok"),
                                                     sniff_magic("content").alias("magic")).collect()]
    assert got == [(True, True), (False, True), (None, True), (None, False)]


def test_name_parsers(spark):
    df = spark.createDataFrame([("ogd-smn_chz_h_historical_2000-2009.csv",), ("ogd-smn_lug_m.csv",), ("x.csv",)], "n string")
    rows = df.select(parse_asset_name("n").alias("a")).collect()
    assert rows[0]["a"].asDict() == {"station": "chz", "gran": "h", "period": "historical", "start_year": 2000, "end_year": 2009}
    assert rows[1]["a"].asDict() == {"station": "lug", "gran": "m", "period": None, "start_year": None, "end_year": None}
    assert rows[2]["a"] is None
    t = spark.createDataFrame([("https://a/b/swissalti3d_2019_2501-1120_0.5_2056_5728.tif",)], "u string") \
        .select(parse_tile_name("u").alias("t")).first()["t"]
    assert (t["year"], t["e_km"], t["n_km"], t["resolution"], t["tile_id"]) == (2019, 2501, 1120, "0.5", "2501-1120")


def test_expect_or_drop_counts_violations(spark):
    from alpina.operators.quality import expect_or_drop
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 500.0), (4, 10.0)], "id long, v double")
    kept, obs = expect_or_drop(df, {"v_present": "v IS NOT NULL", "v_small": "v < 100"})
    assert sorted(r["id"] for r in kept.collect()) == [1, 4]
    m = obs.get
    assert (m["rows_in"], m["v_present_dropped"], m["v_small_dropped"]) == (4, 1, 2)
