"""Keyed table, stateful upserts, file-version stream, header dictionary, resumed weather flow."""

import os
import random

import pytest
from pyspark.sql import functions as F

from alpina.session import list_dir, local_path, path_exists
from alpina.sinks.keyed import KeyedTable
from alpina.sources.delimited import read_delimited_union
from alpina.streaming.bronze import stream_files
from alpina.streaming.scd1 import read_scd1, start_scd1, start_scd1_state, state_size
from alpina.streaming.versions import file_versions, read_bronze, start_bronze

SCHEMA = "k string, seq long, v long"


def rows_of(df):
    return sorted(map(tuple, df.select("k", "seq", "v").collect()), key=str)


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def batches(n, seed=1, size=40):
    rnd = random.Random(seed)
    return [[(rnd.choice([None, *map(str, range(25))]), rnd.randint(0, 50), rnd.randint(0, 9)) for _ in range(size)] for _ in range(n)]


def winners(rows):
    best = {}
    for k, seq, v in rows:
        best[k] = max(best.get(k, (-1, -1)), (seq, v))
    return sorted(((k, *w) for k, w in best.items()), key=str)


def test_read_has_no_exchange_and_equals_the_newest_rows(spark, scratch):
    t = KeyedTable(spark, scratch("keyed"), ["k"], ["seq"], buckets=4)
    assert not t.exists()
    every = []
    for i, rows in enumerate(batches(3)):
        every += rows
        assert t.write(spark.createDataFrame(rows, SCHEMA), f"b{i}")
        assert rows_of(t.read()) == winners(every)
    plan = plan_of(t.read())
    assert "Exchange" not in plan and "Bucketed: true" in plan
    t.fold()
    plan = plan_of(t.read())
    assert "Exchange" not in plan and rows_of(t.read()) == winners(every)
    assert spark.catalog.listTables() == [x for x in spark.catalog.listTables() if not x.name.startswith("alpina_keyed")]


def test_fold_rewrites_only_buckets_that_gathered_files(spark, scratch):
    t = KeyedTable(spark, scratch("keyed"), ["k"], ["seq"], buckets=8)
    for i, rows in enumerate(batches(2)):
        t.write(spark.createDataFrame(rows, SCHEMA), f"b{i}")
    t.fold()
    before = t.files()
    assert len(before) > 4 and all(len(f) == 1 for f in before.values())
    t.write(spark.createDataFrame([("7", 99, 1)], SCHEMA), "late")
    late = [b for b, files in t.files().items() if len(files) == 2]
    assert len(late) == 1 and t.fold() == late
    after = t.files()
    assert {b: f for b, f in after.items() if b not in late} == {b: f for b, f in before.items() if b not in late}
    assert len(after[late[0]]) == 1 and ("7", 99, 1) in rows_of(t.read())


def test_open_reader_survives_a_fold_and_new_ones_skip_what_it_replaced(spark, scratch):
    t = KeyedTable(spark, scratch("keyed"), ["k"], ["seq"], buckets=4)
    for i, rows in enumerate(batches(4)):
        t.write(spark.createDataFrame(rows, SCHEMA), f"b{i}")
    want = rows_of(t.read())
    opened = t.read()
    t.maintain(fold_after=2, keep_seconds=3600)
    assert rows_of(opened) == want  # nothing it listed is gone
    planned = t.read()
    assert t.sweep(0) > 0
    assert rows_of(planned) == want and rows_of(t.read()) == want  # swept files were not in its listing
    assert not any(path_exists(spark, f"{t.path}/rows/b{i}") for i in range(4))
    t.write(spark.createDataFrame(batches(1)[0], SCHEMA), "b0")  # a replay after the sweep
    assert rows_of(t.read()) == want


def test_replay_new_columns_and_other_types(spark, scratch):
    path = scratch("keyed")
    t = KeyedTable(spark, path, ["k"], ["seq"], buckets=4)
    t.write(spark.createDataFrame([("a", 1, 1)], SCHEMA), "one")
    assert not t.write(spark.createDataFrame([("a", 5, 5)], SCHEMA), "one")
    t.write(spark.createDataFrame([("b", 1, "it's")], "k string, seq long, `odd ``name` string"), "two")
    again = KeyedTable(spark, path, ["k"], ["seq"], buckets=99)
    assert again.buckets == 4 and again.read().columns == ["k", "seq", "v", "odd `name"]
    assert sorted(map(tuple, again.read().collect())) == [("a", 1, 1, None), ("b", 1, None, "it's")]
    with pytest.raises(ValueError):
        t.write(spark.createDataFrame([("a", 1, "x")], "k string, seq long, v string"), "three")
    with pytest.raises(ValueError):
        KeyedTable(spark, path, ["v"], ["seq"])
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, scratch("none"), ["k"], ["seq"]).read()


def test_write_that_died_leaves_the_table_as_it_was(spark, scratch, monkeypatch):
    from alpina.sinks import keyed
    t = KeyedTable(spark, scratch("keyed"), ["k"], ["seq"], buckets=4)
    t.write(spark.createDataFrame([("a", 1, 1)], SCHEMA), "one")

    def dies(*_):
        raise OSError("gone")

    monkeypatch.setattr(keyed, "rename_path", dies)
    with pytest.raises(OSError):
        t.write(spark.createDataFrame([("a", 2, 2)], SCHEMA), "two")
    monkeypatch.undo()
    assert rows_of(t.read()) == [("a", 1, 1)]
    assert t.write(spark.createDataFrame([("a", 2, 2)], SCHEMA), "two") and rows_of(t.read()) == [("a", 2, 2)]


def test_stream_folds_between_batches(spark, scratch):
    land, target, ck = scratch("land"), scratch("target"), scratch("ck")
    every = []
    for i, rows in enumerate(batches(5)):
        every += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(land)
    s = stream_files(spark, land, spark.read.parquet(land).schema, "parquet", {"maxFilesPerTrigger": 1})
    start_scd1(s, ["k"], ["seq"], target, ck, buckets=4, fold_after=2, keep_seconds=0)
    assert rows_of(read_scd1(spark, target, ["k"], ["seq"])) == winners(every)
    assert any(n.startswith("fold-") for n in list_dir(spark, f"{target}/rows"))


def test_state_keeps_winners_over_restarts(spark, scratch):
    land, target, ck = scratch("land"), scratch("target"), scratch("ck")
    kind = spark.createDataFrame([("a", 1, 1)], SCHEMA).schema

    def run(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(land)
        return start_scd1_state(stream_files(spark, land, kind, "parquet"), ["k"], ["seq"], target, ck, state_partitions=3, buckets=4)

    run([("a", 2, 1), ("b", 1, 5)])
    query = run([("a", 1, 9), ("b", 1, 5), ("c", 1, None)])  # late, re-delivered, new
    assert rows_of(read_scd1(spark, target, ["k"], ["seq"])) == [("a", 2, 1), ("b", 1, 5), ("c", 1, None)]
    size = state_size(query)
    assert size["keys"] == 3 and size["memory_bytes"] + size["file_bytes"] > 0
    # the second batch by itself holds winners over all batches, not its own older row of "a"
    second = next(n for n in sorted(list_dir(spark, f"{target}/rows")) if n.endswith("-1"))
    assert ("a", 2, 1) in rows_of(spark.read.parquet(f"{target}/rows/{second}"))
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    every = [("a", 2, 1), ("b", 1, 5), ("a", 1, 9), ("c", 1, 0)]
    for rows in batches(2, seed=4):
        run(rows)
        every += rows
    got = [(k, s, v or 0) for k, s, v in rows_of(read_scd1(spark, target, ["k"], ["seq"]))]
    assert got == winners(every)


def put(folder, name, text, mtime):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)
    os.utime(f"{folder}/{name}", (mtime, mtime))


def test_rewritten_path_is_read_again_and_nothing_else(spark, scratch):
    root, out, ck = local_path(scratch("land")), scratch("out"), scratch("ck")
    put(root, "a.csv", "k;p\n1;x\n", 1_700_000_000)
    put(root, "sub/b.csv".split("/")[1], "k;p\n2;y\n", 1_700_000_000)
    put(f"{root}/deep", "c.csv", "k;p\n3;z\n", 1_700_000_000)
    put(root, "_hidden.csv", "k;p\n9;h\n", 1_700_000_000)
    put(root, "other.txt", "k;p\n9;t\n", 1_700_000_000)

    def run():
        start_bronze(spark, root, "*.csv", out, ck, key_col="k")
        return sorted((r["k"], r["p"], r["_batch"]) for r in read_bronze(spark, out).collect())

    first = [("1", "x", 0), ("2", "y", 0), ("3", "z", 0)]
    assert run() == first
    put(root, "a.csv", "k;p;new\n1;x2;n;s1;s2\n", 1_700_000_100)  # one more column, two surplus fields
    assert run() == sorted([*first, ("1", "x2", 1)])
    row = read_bronze(spark, out).where("_batch = 1").first()
    assert (row["new"], row["_rescued"]) == ("n", {"_c3": "s1", "_c4": "s2"}) and row["source_file"].endswith("/a.csv")
    assert run() == sorted([*first, ("1", "x2", 1)])  # a third trigger reads nothing
    assert len(list_dir(spark, out)) == 2 and not any(n.startswith("v=") for n in list_dir(spark, root))


def test_replayed_batch_of_file_versions_is_there_once(spark, scratch, monkeypatch):
    root, out, ck = local_path(scratch("land")), scratch("out"), scratch("ck")
    put(root, "a.csv", "k;p\n1;x\n", 1_700_000_000)
    start_bronze(spark, root, "*.csv", out, ck)
    commits = f"{local_path(ck)}/commits"
    for n in os.listdir(commits):  # as after a crash between the write and the commit
        if n.strip(".").startswith("0"):
            os.replace(f"{commits}/{n}", f"{local_path(ck)}/lost-{n.strip('.')}")
    start_bronze(spark, root, "*.csv", out, ck)
    assert [(r["k"], r["p"]) for r in read_bronze(spark, out).collect()] == [("1", "x")]


def test_young_files_wait(spark, scratch):
    root, out, ck = local_path(scratch("land")), scratch("out"), scratch("ck")
    import time
    put(root, "a.csv", "k;p\n1;x\n", time.time())
    start_bronze(spark, root, "*.csv", out, ck, settle_ms=600_000)
    assert read_bronze(spark, out) is None
    start_bronze(spark, root, "*.csv", out, ck, settle_ms=0)
    assert read_bronze(spark, out).count() == 1
    assert file_versions(spark, root).columns == ["path", "name", "size", "modified"]


def test_thousands_of_headers_are_one_plan(spark, scratch):
    root = local_path(scratch("headers"))
    for i in range(2000):
        put(root, f"f{i}.csv", f"k;p{i % 40};only{i}\n{i};v{i};o\n{i}b;w;o;extra{i}\n", 1_700_000_000)
    df = read_delimited_union(spark, root, ";", "k", rescued="_rescued")
    assert len(df.columns) == 1 + 40 + 2000 + 1
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 2
    some = df.select("k", "p7", "only47", F.col("_rescued")).where("p7 IS NOT NULL").collect()
    assert len(some) == 2 * 50
    by = {r["k"]: r for r in some}
    assert (by["47"]["p7"], by["47"]["only47"], by["47"]["_rescued"]) == ("v47", "o", None)
    assert (by["87b"]["p7"], by["87b"]["only47"], by["87b"]["_rescued"]) == ("w", None, {"_c3": "extra87"})


def test_fields_of_lines(spark, scratch):
    root = local_path(scratch("fields"))
    put(root, "a.csv", '﻿k;"a;x";b;b\n1;"q ""y"" ;";;""\n\n2;bad"quote;"open;"t"ail\n3\n4;;;;\nk;"a;x";b;b\n;"";x\n', 1_700_000_000)
    got = sorted(read_delimited_union(spark, root, ";", "k", rescued="r").collect(), key=lambda r: r["k"] or "~")
    assert [tuple(r)[:4] for r in got] == [("1", 'q "y" ;', None, ""), ("2", 'bad"quote', '"open', '"t"ail'), ("3", None, None, None),
                                          ("4", None, None, None), ("k", "a;x", "b", "b"), (None, "", "x", None)]
    assert got[0].__fields__ == ["k", "a;x", "b", "b.1", "r"] and got[3]["r"] == {"_c4": ""}
    kept = sorted(read_delimited_union(spark, root, ";", "k", keep_empty=True).collect(), key=lambda r: r["k"] or "~")
    assert [tuple(r) for r in kept][2:4] == [("3", None, None, None), ("4", "", "", "")] and tuple(kept[5]) == ("", "", "x", None)
    with pytest.raises(ValueError):
        read_delimited_union(spark, root, ";", "other")


def weather_counts(out, name):
    return out[name][0].count(), out[name][1]


def test_weather_flow_takes_up_a_run_that_died_before_silver(spark, scratch, monkeypatch):
    from alpina.plans.flows import weather_flow
    root = local_path(scratch("wf"))
    folders = {"hourly": f"{root}/hourly"}
    put(folders["hourly"], "a.csv", "station_abbr;reference_timestamp;t\nabc;01.01.2024 00:00;1.5\nabc;01.01.2024 01:00;2.5;99;77\n", 1_700_000_000)

    def dies(*_):
        raise OSError("gone")

    monkeypatch.setattr(KeyedTable, "write", dies)
    with pytest.raises(OSError):
        weather_flow(spark, folders, f"{root}/work")
    monkeypatch.undo()
    out = weather_flow(spark, folders, f"{root}/work")  # its files are logged, its rows were not in silver
    assert weather_counts(out, "hourly") == (2, {"rows_in": 2, "valid_key_dropped": 0})
    assert weather_counts(weather_flow(spark, folders, f"{root}/work"), "hourly") == (2, {"rows_in": 0, "valid_key_dropped": 0})
    bronze = spark.read.parquet(*[f"{root}/work/bronze/hourly/{n}" for n in os.listdir(f"{root}/work/bronze/hourly") if n.startswith("run=")])
    assert {tuple(sorted(r["_rescued"].items())) for r in bronze.collect() if r["_rescued"]} == {(("_c3", "99"), ("_c4", "77"))}


def test_weather_flow_comes_back_to_a_value_that_types_refuse(spark, scratch):
    from alpina.plans.flows import weather_flow
    root = local_path(scratch("wf"))
    folders = {"hourly": f"{root}/hourly"}
    head = "station_abbr;reference_timestamp;t\n"
    put(folders["hourly"], "a.csv", head + "abc;01.01.2024 00:00;x1\n", 1_700_000_000)
    for _ in range(2):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            weather_flow(spark, folders, f"{root}/work")
