"""Sinks: staged overwrite of a table read by the same plan, retention, manifest merge,
evolving append, emptied partitions on replacement."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from alpina.session import list_dir
from alpina.sinks.ledger import merge_manifest
from alpina.sinks.tables import (
    append_evolving, expire_partitions, overwrite_table, read_evolving, read_replaced, replace_by_key, write_dated_partitions,
)


def test_overwrite_from_itself(spark, scratch):
    p = scratch("ow")
    spark.range(10).write.parquet(p)
    n = overwrite_table(spark.read.parquet(p).where("id % 2 = 0").withColumn("x", F.col("id") * 2), p)
    assert n == 5 and spark.read.parquet(p).columns == ["id", "x"]


def test_expire_partitions_keeps_other_folders(spark, scratch):
    p = scratch("ret")
    df = spark.createDataFrame([(datetime(2024, 1, d),) for d in (10, 14, 15, 20)], "ts timestamp")
    write_dated_partitions(df, p, "ts")
    spark.range(1).write.parquet(f"{p}/notes")
    gone = expire_partitions(spark, p, datetime(2024, 1, 15, 6))
    # a folder's date counts as midnight: 2024-01-15 00:00 is older than 2024-01-15 06:00
    assert gone == ["date=2024-01-10", "date=2024-01-14", "date=2024-01-15"]
    assert sorted(n for n in list_dir(spark, p) if not n.startswith("_")) == ["date=2024-01-20", "notes"]


def test_replace_drops_rows_of_ids_that_yield_none(spark, scratch):
    p = scratch("rep")
    rows = [(i, f"f{i}") for i in range(40)]
    replace_by_key(spark.createDataFrame(rows, "v long, file_id string"), p, "file_id")
    # f1..f3 re-processed: f1 now yields no rows, f2 yields a new row
    batch = spark.createDataFrame([(100, "f2")], "v long, file_id string")
    ids = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "file_id string")
    replace_by_key(batch, p, "file_id", ids=ids)
    got = sorted(map(tuple, read_replaced(spark, p, "file_id").select("v", "file_id").collect()))
    assert got == sorted([r for r in rows if r[1] not in ("f1", "f2", "f3")] + [(100, "f2")])


def test_replace_that_dies_before_its_marker_loses_nothing(spark, scratch, monkeypatch):
    from alpina.sinks import tables
    p = scratch("repdie")
    replace_by_key(spark.createDataFrame([(1, "a"), (2, "b")], "v long, file_id string"), p, "file_id")
    batch = spark.createDataFrame([(3, "a")], "v long, file_id string")
    real = tables.write_text_file

    def dies(*args, **kwargs):
        raise OSError("the driver is gone")
    monkeypatch.setattr(tables, "write_text_file", dies)
    for _ in range(2):
        with pytest.raises(OSError):
            replace_by_key(batch, p, "file_id")
        assert sorted(map(tuple, read_replaced(spark, p, "file_id").collect())) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(tables, "write_text_file", real)
    replace_by_key(batch, p, "file_id")
    assert sorted(map(tuple, read_replaced(spark, p, "file_id").collect())) == [(2, "b"), (3, "a")]


def test_folded_batches_give_the_same_table(spark, scratch):
    p = scratch("fold")
    for i in range(5):
        replace_by_key(spark.createDataFrame([(10 * i + k, f"f{k}") for k in range(i, 5)], "v long, file_id string"), p, "file_id", fold_after=3)
    got = sorted(map(tuple, read_replaced(spark, p, "file_id").collect()))
    assert got == sorted((11 * k, f"f{k}") for k in range(5))
    assert len([n for n in list_dir(spark, p) if n.startswith("batch=")]) <= 3


def test_merge_manifest_replaces_whole_records(spark):
    old = spark.createDataFrame([("p1", ("c1", 1)), ("p2", ("c2", 2))], "path string, record struct<ck:string,n:int>")
    new = spark.createDataFrame([("p2", ("c9", None)), ("p3", ("c3", 3))], "path string, record struct<ck:string,n:int>")
    got = {r["path"]: tuple(r["record"]) for r in merge_manifest(old, new).collect()}
    assert got == {"p1": ("c1", 1), "p2": ("c9", None), "p3": ("c3", 3)}


def test_append_evolving_adds_columns(spark, scratch):
    p = scratch("evo")
    append_evolving(spark.createDataFrame([(1,)], "a long"), p)
    append_evolving(spark.createDataFrame([(2, "x")], "a long, b string"), p)
    got = sorted(map(tuple, read_evolving(spark, p).select("a", "b").collect()))
    assert got == [(1, None), (2, "x")]


def test_ingest_json_quarantines_bad_file_and_fails_at_end(spark, scratch):
    import os
    import pytest
    from alpina.operators.quality import QuarantineError
    from alpina.plans.flows import ingest_flow
    from alpina.session import local_path
    root = scratch("ingest_json")
    land = local_path(f"{root}/landing/live/date=2024-01-01")
    os.makedirs(land, exist_ok=True)
    with open(f"{land}/a.json", "w") as f:
        f.write('[{"Station Code": "abc", "hs": 1.50, "o": {"x": 1}}, {"Station Code": "def", "hs": null}]')
    with open(f"{land}/b.json", "w") as f:
        f.write('[{"Station Code": "ghi", "hs": 2}, {"Station Code": ')
    target, ledger = f"{root}/bronze", f"{root}/_ledger"
    with pytest.raises(QuarantineError):
        ingest_flow(spark, f"{root}/landing", "*.json", target, ledger, "bronze_live", fmt="json")
    rows = {r["station_code"]: r.asDict() for r in spark.read.parquet(target).collect()}
    assert set(rows) == {"abc", "def"} and rows["abc"]["hs"] == "1.50"
    assert rows["abc"]["_source_file"].endswith("a.json")
    logged = [r["file_name"] for r in spark.read.parquet(ledger).collect()]
    assert logged == ["a.json"]                      # the rejected file is retried next run
    assert spark.read.parquet(f"{target}_errors").count() == 1


def test_overwrite_recovers_interrupted_swap(spark, scratch):
    from alpina.sinks.tables import recover_table
    from alpina.session import hadoop_fs
    p = scratch("swap")
    spark.range(3).write.parquet(p)
    fs, src = hadoop_fs(spark, p)
    _, dst = hadoop_fs(spark, p + ".__old_deadbeef")
    fs.rename(src, dst)                      # crash after "rename old away"
    assert recover_table(spark, p)
    assert spark.read.parquet(p).count() == 3
    assert overwrite_table(spark.read.parquet(p).where("id > 0"), p) == 2


def test_json_known_keys_single_pass(spark, scratch):
    import os
    from alpina.session import local_path
    from alpina.sources.json_text import read_json_strings
    root = scratch("jk")
    os.makedirs(local_path(root), exist_ok=True)
    with open(local_path(root) + "/a.json", "w") as f:
        f.write('{"a": 1, "b": {"x": true}}\n{"a": 2}\n')
    df = read_json_strings(spark, root, multi_line=False, keys=["a", "b", "c"])
    got = sorted((r["a"], r["b"], r["c"]) for r in df.collect())
    assert got[0][0] == "1" and got[0][1].replace(" ", "") == '{"x":true}' and got[0][2] is None
    assert got[1] == ("2", None, None)


def test_ingest_csv_binds_columns_by_name_across_headers(spark, scratch):
    import os
    from alpina.plans.flows import ingest_flow
    from alpina.session import local_path
    root = scratch("ingest_csv")
    land = local_path(f"{root}/landing")
    os.makedirs(land, exist_ok=True)
    with open(f"{land}/a.csv", "w") as f:
        f.write("Station,HS,TA\nabc,1,2\n")
    with open(f"{land}/b.csv", "w") as f:
        f.write("TA,Station,RR\n7,def,9\n")
    with open(f"{land}/c.csv", "w") as f:
        f.write("Station,HS,TA\n")               # header only: a file with 0 rows
    target, ledger = f"{root}/bronze", f"{root}/_ledger"
    ingest_flow(spark, f"{root}/landing", "*.csv", target, ledger, "bronze_csv")
    rows = {r["station"]: r.asDict() for r in spark.read.option("mergeSchema", True).parquet(target).collect()}
    assert (rows["abc"]["hs"], rows["abc"]["ta"], rows["abc"]["rr"]) == ("1", "2", None)
    assert (rows["def"]["hs"], rows["def"]["ta"], rows["def"]["rr"]) == (None, "7", "9")
    counts = {r["file_name"]: r["row_count"] for r in spark.read.parquet(ledger).collect()}
    assert counts == {"a.csv": 1, "b.csv": 1, "c.csv": 0}
    # a second run finds nothing new
    assert ingest_flow(spark, f"{root}/landing", "*.csv", target, ledger, "bronze_csv").count() == 0


def land(root, name, text):
    import os
    from alpina.session import local_path
    path = f"{local_path(root)}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


def run_ingest(spark, root, pattern, **kwargs):
    """(rows by file, ledger counts, rejected files) of an ingest run."""
    from alpina.plans.flows import ingest_flow
    from alpina.session import path_exists
    target, ledger = f"{root}/bronze", f"{root}/_ledger"
    ingest_flow(spark, f"{root}/landing", pattern, target, ledger, "t", raise_on_errors=False, **kwargs)
    name = F.regexp_extract("_source_file", "([^/]+)$", 1).alias("file")
    rows = {}
    if list_dir(spark, target) and any(n.startswith("run=") for n in list_dir(spark, target)):
        for r in spark.read.option("mergeSchema", True).parquet(target).select("*", name).collect():
            rows.setdefault(r["file"], []).append(r)
    counts = {r["file_name"]: r["row_count"] for r in spark.read.parquet(ledger).collect()}
    bad = f"{target}_errors"
    errors = {r["file"].rsplit("/", 1)[1] for r in spark.read.parquet(bad).collect()} if path_exists(spark, bad) else set()
    return rows, counts, errors


def test_ingest_decides_array_or_lines_per_file(spark, scratch):
    root = scratch("mixjson")
    land(root, "landing/array.json", "[\n" + ",\n".join(f'{{"a": {i}}}' for i in range(20)) + "\n]")
    land(root, "landing/lines.json", '\n{"a": 1, "b": "x"}\n{"a": 2}\n{"a": 3}\n')
    land(root, "landing/with space.json", '{"a": 7')
    land(root, "landing/none.json", "")
    rows, counts, errors = run_ingest(spark, root, "*.json", fmt="json")
    assert {k: len(v) for k, v in rows.items()} == {"array.json": 20, "lines.json": 3}
    assert counts == {"array.json": 20, "lines.json": 3, "none.json": 0}
    assert errors == {"with%20space.json"}  # not logged, so the next run retries it
    land(root, "landing/with space.json", '{"a": 7}')
    rows, counts, _ = run_ingest(spark, root, "*.json", fmt="json")
    assert len(rows["with%20space.json"]) == 1 and counts["with space.json"] == 1


def test_ingest_csv_rejects_only_bad_files(spark, scratch):
    root = scratch("badcsv")
    land(root, "landing/good file.csv", "Name,N\nabc,1\n,2\nshort\n")
    land(root, "landing/surplus.csv", "Name,N\ndef,2,EXTRA\n")
    land(root, "landing/collide.csv", "a b,a_b\n1,2\n")
    land(root, "landing/empty.csv", "")
    land(root, "landing/twice.csv", "a,a\n1,2\n")
    rows, counts, errors = run_ingest(spark, root, "*.csv")
    got = {(r["name"], r["n"]) for r in rows["good%20file.csv"]}
    assert got == {("abc", "1"), ("", "2"), ("short", None)}  # an empty field stays empty, a lacking one is NULL
    assert (rows["twice.csv"][0]["a"], rows["twice.csv"][0]["a_1"]) == ("1", "2")
    assert counts == {"good file.csv": 3, "twice.csv": 1}
    assert errors == {"surplus.csv", "collide.csv", "empty.csv"}


def test_ingest_rejects_unreadable_parquet_alone(spark, scratch):
    from alpina.session import local_path
    root = scratch("badpq")
    spark.createDataFrame([(1, "x")], "A long, `B c` string").coalesce(1).write.parquet(f"{root}/landing/p")
    land(root, "landing/bad.parquet", b"PAR1 not really PAR1")
    rows, counts, errors = run_ingest(spark, root, "*.parquet", fmt="parquet")
    assert [(r["a"], r["b_c"]) for v in rows.values() for r in v] == [(1, "x")]
    assert errors == {"bad.parquet"} and sum(counts.values()) == 1 and local_path(root)


def test_ingest_that_dies_before_the_ledger_duplicates_nothing(spark, scratch, monkeypatch):
    from alpina.plans import flows
    root = scratch("dies")
    land(root, "landing/a.csv", "x\n1\n2\n")

    def dies(*args):
        raise OSError("the driver is gone")
    with monkeypatch.context() as m:
        m.setattr(flows, "record_ledger", dies)
        with pytest.raises(OSError):
            flows.ingest_flow(spark, f"{root}/landing", "*.csv", f"{root}/bronze", f"{root}/_ledger", "t")
    land(root, "landing/b.csv", "x\n3\n")
    rows, counts, _ = run_ingest(spark, root, "*.csv")
    assert {k: len(v) for k, v in rows.items()} == {"a.csv": 2, "b.csv": 1} and counts == {"a.csv": 2, "b.csv": 1}


def test_listing_names_files_as_their_rows_do(spark, scratch):
    from alpina.sources.files import list_files, source_path
    root = scratch("names")
    names = ["a b.csv", "c%20d.csv", "e+f&g=h,i.csv", "ü[1].csv", "zero.csv"]
    for n in names:
        land(root, f"x=1/{n}", "" if n == "zero.csv" else "v\n1\n")
    listed = {r["name"]: r for r in list_files(spark, root, "*.csv").collect()}
    assert set(listed) == set(names) and listed["zero.csv"]["size"] == 0
    read = {r[0] for r in spark.read.option("recursiveFileLookup", True).text(root).select(source_path()).distinct().collect()}
    assert read == {r["path"] for n, r in listed.items() if n != "zero.csv"}


def test_large_csv_file_is_split_among_tasks(spark, scratch):
    from alpina.sources.delimited import read_delimited
    root = scratch("split")
    spark.range(200_000).selectExpr("cast(id as string) AS a", "repeat('x', 40) AS b").coalesce(1).write.option("header", True).csv(root)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        df = read_delimited(spark, root)
        assert df.rdd.getNumPartitions() >= 5 and df.count() == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
