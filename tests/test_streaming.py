"""Streaming: SCD1 late data and NULL overwrite, re-ingest of rewritten files, stream/batch
equality."""

from pyspark.sql import functions as F

from alpina.session import path_exists
from alpina.streaming.bronze import bronze_stream, run_append, stream_files
from alpina.streaming.scd1 import compact_scd1, read_scd1, start_scd1
from alpina.sources.delimited import write_delimited


def test_scd1_late_rows_lose_and_nulls_overwrite(spark, scratch):
    land = scratch("scd_land")
    schema = "k string, seq long, v double"
    batches = [
        [("a", 2, 1.0), ("b", 1, 5.0)],
        [("a", 1, 9.0)],                  # late, older: must not win
        [("b", 3, None), ("c", 1, 7.0)],  # newer with NULL value: NULL wins
    ]
    target, ck = scratch("scd_target"), scratch("scd_ck")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{land}/b{i}")
        s = stream_files(spark, f"{land}/b*", spark.read.parquet(f"{land}/b0").schema, "parquet")
        start_scd1(s, ["k"], ["seq"], target, ck)
    got = sorted(map(tuple, read_scd1(spark, target, ["k"], ["seq"]).select("k", "seq", "v").collect()))
    assert got == [("a", 2, 1.0), ("b", 3, None), ("c", 1, 7.0)]
    # compaction folds the change batches into a base without changing the table
    assert compact_scd1(spark, target, ["k"], ["seq"])
    again = sorted(map(tuple, read_scd1(spark, target, ["k"], ["seq"]).select("k", "seq", "v").collect()))
    assert again == got
    # a folder that is being written is neither read nor folded nor deleted
    half = f"{target}/_stage/other-7"
    spark.createDataFrame([("a", 99, 9.0)], schema).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert compact_scd1(spark, target, ["k"], ["seq"]) == [] and path_exists(spark, half)
    # a later batch after compaction still upserts
    spark.createDataFrame([("a", 5, 2.0), ("c", 0, 1.0)], schema).write.mode("overwrite").parquet(f"{land}/b9")
    start_scd1(stream_files(spark, f"{land}/b*", spark.read.parquet(f"{land}/b0").schema, "parquet"),
               ["k"], ["seq"], target, ck)
    final = sorted(map(tuple, read_scd1(spark, target, ["k"], ["seq"]).select("k", "seq", "v").collect()))
    assert final == [("a", 5, 2.0), ("b", 3, None), ("c", 1, 7.0)]


def test_rewritten_file_is_ingested_again_under_new_version(spark, scratch):
    root, out, ck = scratch("ri_land"), scratch("ri_out"), scratch("ri_ck")
    df = spark.createDataFrame([("1", "x")], "id string, val string")
    write_delimited(df, f"{root}/v=1", sep=";")
    schema = "id string, val string, v string"
    opts = {"header": "true", "sep": ";"}
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    run_append(bronze_stream(spark, root, st, "csv", opts), out, ck)
    write_delimited(df.withColumn("val", F.lit("y")), f"{root}/v=2", sep=";")
    run_append(bronze_stream(spark, root, st, "csv", opts), out, ck)
    got = sorted((r["val"], r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [("x", "1"), ("y", "2")]


def test_stream_rejects_file_with_other_header(spark, scratch):
    """A CSV file stream binds by position; with enforceSchema=false a later file whose
    header differs fails the stream instead of silently mixing columns."""
    import os
    import pytest
    from alpina.session import local_path
    from pyspark.sql.types import StringType, StructField, StructType
    root, out, ck = scratch("hdr_land"), scratch("hdr_out"), scratch("hdr_ck")
    os.makedirs(local_path(root), exist_ok=True)
    with open(f"{local_path(root)}/a.csv", "w") as f:
        f.write("station_abbr;p1\nAAA;1\n")
    schema = StructType([StructField("station_abbr", StringType()), StructField("p1", StringType())])
    opts = {"header": "true", "sep": ";", "enforceSchema": "false"}
    run_append(bronze_stream(spark, root, schema, "csv", opts), out, ck)
    with open(f"{local_path(root)}/b.csv", "w") as f:
        f.write("station_abbr;p2\nBBB;2\n")
    with pytest.raises(Exception):
        run_append(bronze_stream(spark, root, schema, "csv", opts), out, ck)


def test_scd1_stream_equals_batch_for_any_order_and_split(spark, scratch):
    """SURVEY §5.5/5.6: the streaming upsert equals batch latest-per-key, whatever the arrival
    order of the rows and however they are split into micro-batches."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st
    from alpina.operators.dedupe import latest_per_key

    rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5), st.integers(0, 9)),
                       min_size=1, max_size=12)

    @settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
    @given(rows=rows_st, cuts=st.lists(st.integers(1, 11), max_size=3), seed=st.randoms())
    def check(rows, cuts, seed):
        schema = "k string, seq long, v long"
        expected = sorted(map(tuple, latest_per_key(spark.createDataFrame(rows, schema), ["k"], ["seq"]).collect()))
        shuffled = list(rows)
        seed.shuffle(shuffled)
        bounds = sorted({c for c in cuts if c < len(shuffled)})
        parts = [shuffled[a:b] for a, b in zip([0] + bounds, bounds + [len(shuffled)]) if shuffled[a:b]]
        land, target, ck = scratch("eq_land"), scratch("eq_target"), scratch("eq_ck")
        for i, p in enumerate(parts):
            spark.createDataFrame(p, schema).write.parquet(f"{land}/b{i:02d}")
        s = stream_files(spark, f"{land}/b*", spark.read.parquet(f"{land}/b00").schema, "parquet",
                         {"maxFilesPerTrigger": 1})
        start_scd1(s, ["k"], ["seq"], target, ck)
        got = sorted(map(tuple, read_scd1(spark, target, ["k"], ["seq"]).select("k", "seq", "v").collect()))
        assert got == expected

    check()


def test_new_checkpoint_keeps_the_changes_of_the_old_one(spark, scratch):
    land, target = scratch("cp_land"), scratch("cp_target")
    schema = "k string, seq long, v double"
    spark.createDataFrame([("a", 2, 1.0), ("b", 1, 5.0)], schema).write.parquet(f"{land}/b0")
    kind = spark.read.parquet(f"{land}/b0").schema
    start_scd1(stream_files(spark, f"{land}/b0", kind, "parquet"), ["k"], ["seq"], target, scratch("cp_one"))
    spark.createDataFrame([("c", 1, 3.0)], schema).write.parquet(f"{land}/x0")
    start_scd1(stream_files(spark, f"{land}/x0", kind, "parquet"), ["k"], ["seq"], target, scratch("cp_two"))
    got = sorted(map(tuple, read_scd1(spark, target, ["k"], ["seq"]).select("k", "seq", "v").collect()))
    assert got == [("a", 2, 1.0), ("b", 1, 5.0), ("c", 1, 3.0)]


def weather_file(path, header, rows, mtime=None):
    import os
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([header, *rows]) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))


def test_weather_flow_granularities_rewrites_and_new_columns(spark, scratch):
    from alpina.plans.flows import weather_flow
    from alpina.session import local_path
    root = local_path(scratch("wf"))
    folders = {g: f"{root}/{g}" for g in ("hourly", "daily")}
    head = "station_abbr;reference_timestamp;t"
    weather_file(f"{folders['hourly']}/a.csv", head, ["abc;01.01.2024 00:00;1.5", "abc;01.01.2024 01:00;2.5"], 1_700_000_000)
    weather_file(f"{folders['daily']}/a.csv", head, ["abc;01.01.2024 00:00;9.5", ";01.01.2024 00:00;7"], 1_700_000_000)

    def silver(out, name, *cols):
        return sorted(tuple(r) for r in out[name][0].selectExpr("station_abbr", "hour(reference_ts)", *cols).collect())

    out = weather_flow(spark, folders, f"{root}/work")
    assert silver(out, "hourly", "t") == [("ABC", 0, 1.5), ("ABC", 1, 2.5)]  # one table per granularity
    assert silver(out, "daily", "t") == [("ABC", 0, 9.5)]
    assert out["daily"][1] == {"rows_in": 2, "valid_key_dropped": 1}
    # the same path rewritten, and a second file with one more column in another order
    weather_file(f"{folders['hourly']}/a.csv", head, ["abc;01.01.2024 00:00;1.5", "abc;01.01.2024 01:00;", "abc;01.01.2024 02:00;4"], 1_700_000_100)
    weather_file(f"{folders['hourly']}/b.csv", "station_abbr;rain;reference_timestamp;t", ["def;3;01.01.2024 00:00;8"], 1_700_000_100)
    out = weather_flow(spark, folders, f"{root}/work")
    assert silver(out, "hourly", "t", "rain") == [("ABC", 0, 1.5, None), ("ABC", 1, None, None), ("ABC", 2, 4.0, None), ("DEF", 0, 8.0, 3.0)]
    assert out["daily"][1] == {"rows_in": 0, "valid_key_dropped": 0}
    assert silver(weather_flow(spark, folders, f"{root}/work"), "hourly", "t") == silver(out, "hourly", "t")
