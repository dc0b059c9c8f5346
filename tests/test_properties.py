"""Property tests (hypothesis): operators equal their sequential / Python definitions."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from alpina.operators.budget import budget_prefix
from alpina.operators.changes import changed_by_time
from alpina.operators.dedupe import latest_per_key
from alpina.sinks.tables import read_replaced, replace_by_key

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(sizes=st.lists(st.integers(0, 1000), min_size=1, max_size=60), budget=st.one_of(st.none(), st.integers(0, 20000)),
       reserve=st.integers(0, 500))
def test_budget_prefix_equals_sequential_latch(spark, sizes, budget, reserve):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size long")
    got = sorted(r["id"] for r in budget_prefix(df, "size", ["id"], budget, reserve, num_ranges=4).collect())
    left = None if budget is None else budget - reserve
    exp, exhausted = [], False
    for i, s in enumerate(sizes):          # a budget that closes at the first row it cannot hold
        if left is None:
            exp.append(i)
            continue
        if exhausted or s > left:
            exhausted = True
            continue
        left -= s
        exp.append(i)
    assert got == exp


def test_budget_prefix_of_many_rows_is_exact_and_repeatable(spark):
    from pyspark.sql import functions as F
    n = 2_000_000
    df = spark.range(n, numPartitions=8).select(F.pmod(F.col("id") * 7919, F.lit(n)).alias("k"))
    df = df.withColumn("size", F.pmod("k", F.lit(5)))
    total = lambda k: (F.col(k) / 5).cast("long") * 10 + F.element_at(F.array(*map(F.lit, [0, 1, 3, 6, 10])), (F.pmod(k, F.lit(5)) + 1).cast("int"))
    for _ in range(2):
        out = budget_prefix(df, "size", ["k"], budget=1_000_000, reserve=7, num_ranges=16)
        row = out.agg(F.count(F.lit(1)), F.max("running_bytes"), F.count_if(F.col("running_bytes") != total("k"))).first()
        assert tuple(row) == (499_998, 999_993, 0)


def test_budget_prefix_on_the_bench_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "n_chars")
    got = {r["doc_id"]: r["running_bytes"] for r in budget_prefix(d.repartition(7), "n_chars", ["doc_id"], None).collect()}
    acc = 0
    for r in d.orderBy("doc_id").collect():
        acc += r["n_chars"]
        assert got[r["doc_id"]] == acc
    plan = budget_prefix(d, "n_chars", ["doc_id"], None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan


@SETTINGS
@given(files=st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 30), min_size=1, max_size=12),
       logged=st.dictionaries(st.text("abc", min_size=1, max_size=3), st.lists(st.integers(0, 30), min_size=1, max_size=3),
                              max_size=12))
def test_changed_by_time_equals_python_predicate(spark, files, logged):
    fmt = lambda d: (datetime(2024, 1, 1) + timedelta(days=d)).strftime("%Y-%m-%dT%H:%M:%SZ")
    listing = spark.createDataFrame([(k, fmt(v)) for k, v in files.items()], "file_id string, modified_time string")
    rows = [(k, fmt(v), "t") for k, vs in logged.items() for v in vs]
    ledger = spark.createDataFrame(rows, "file_id string, modified_time string, target_table string")
    got = sorted(r["file_id"] for r in changed_by_time(listing, ledger, target="t").collect())
    last = {k: max(fmt(v) for v in vs) for k, vs in logged.items()}
    exp = sorted(k for k, v in files.items() if k not in last or fmt(v) > last[k])
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 3), st.integers(0, 100)), min_size=1, max_size=40),
       split=st.integers(1, 39))
def test_latest_per_key_independent_of_split_and_order(spark, rows, split):
    schema = "k long, seq long, v long"
    whole = latest_per_key(spark.createDataFrame(rows, schema), ["k"], ["seq"])
    a, b = rows[:split], rows[split:]
    parts = [latest_per_key(spark.createDataFrame(p, schema), ["k"], ["seq"]) for p in (a, b) if p]
    merged = parts[0] if len(parts) == 1 else latest_per_key(parts[1].unionByName(parts[0]), ["k"], ["seq"])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(batch_ids=st.lists(st.integers(0, 9), min_size=1, max_size=5, unique=True), keep_mod=st.integers(1, 3))
def test_replace_by_key_idempotent(spark, scratch, batch_ids, keep_mod):
    base = [(i, f"f{i % 10}", 1.0) for i in range(60)]
    path = scratch("rbk")
    df = spark.createDataFrame(base, "row_id long, file_id string, v double")
    replace_by_key(df, path, "file_id")
    batch_rows = [(i, f"f{i % 10}", 2.0) for i in range(60) if (i % 10) in batch_ids and i % keep_mod == 0]
    batch = spark.createDataFrame(batch_rows, "row_id long, file_id string, v double")
    replace_by_key(batch, path, "file_id")
    once = sorted(map(tuple, read_replaced(spark, path, "file_id").collect()))
    replace_by_key(batch, path, "file_id")
    twice = sorted(map(tuple, read_replaced(spark, path, "file_id").collect()))
    present = {f for _, f, _ in batch_rows}
    exp = sorted([r for r in base if r[1] not in present] + batch_rows)
    assert once == twice == exp


@SETTINGS
@given(files=st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 4000), min_size=1, max_size=10),
       logged=st.dictionaries(st.text("abc", min_size=1, max_size=3), st.integers(0, 4000), max_size=10))
def test_changed_by_epoch_sees_whole_seconds_only(spark, files, logged):
    from alpina.operators.changes import changed_by_epoch
    t0 = datetime(2024, 1, 1)
    at = lambda ms: t0 + timedelta(milliseconds=ms)
    listing = spark.createDataFrame([(k, k, at(v)) for k, v in files.items()],
                                    "file_id string, file_name string, modified_time timestamp")
    ledger = spark.createDataFrame([(k, at(v), "t") for k, v in logged.items()] or [("zz", t0, "x")],
                                   "file_id string, modified_time timestamp, target_table string")
    got = [r["file_id"] for r in changed_by_epoch(listing, ledger, target="t").collect()]
    sec = lambda ms: ms // 1000
    exp = sorted(k for k, v in files.items() if k not in logged or sec(v) > sec(logged[k]))
    assert got == exp
