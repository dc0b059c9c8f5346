import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as ent
from alpina.llm import mixing, queries, sharding
from tools.compare import TABLES, duck_rows, key, spark_rows

from llm_helpers import docs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sc, _, sr = spark_rows(ent.queries()[name](spark, SF))
    dc, _, dr = duck_rows(con, ent.oracle_sql()[name])
    assert sc == dc
    assert sorted(sr, key=key) == sorted(dr, key=key)


def plan_rows(df):
    plan = mixing.mix_plan(df, mixing.word_count("text"))
    return plan.select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()


def level_targets(sizes):
    """Brute force: reshare the excess until no source is above three times its size."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        w = sum(weight[s] for s in names if s not in full)
        target = {s: 3 * sizes[s] if s in full else weight[s] * left / w for s in names}
        above = {s for s in names if s not in full and target[s] > 3 * sizes[s] * (1 + 1e-12)}
        if not above:
            return target
        full |= above


def test_mixing_follows_targets(spark):
    rng = random.Random(3)
    texts, sources = [], []
    for i in range(900):
        sources.append(rng.choice(["big"] * 8 + ["b", "c", None]))
        texts.append(" ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([1, 5, 40, 40, 40, 200]))))
    rows = plan_rows(docs(spark, texts, sources=sources))
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(t.split())
    want = level_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r["size"] == len(texts[r["doc_id"]].split())
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["size"] * r["copies"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * 200 + 3
    again = plan_rows(docs(spark, texts, sources=sources, parts=7))
    assert sorted(rows, key=str) == sorted(again, key=str)


def test_mixing_emits_once_per_crossed_integer(spark):
    df = docs(spark, ["a b c"] * 50, sources=["x"] * 40 + ["y"] * 10)
    rows = defaultdict(list)
    for r in plan_rows(df):
        rows[r["source"]].append(r)
    for s, rs in rows.items():
        rate = rs[0]["target"] / rs[0]["source_size"]
        assert {r["copies"] for r in rs} <= {math.floor(rate), math.ceil(rate)}
        assert abs(sum(r["copies"] for r in rs) - rate * len(rs)) <= 1
    drawn = mixing.mix_sources(df)
    assert drawn.columns == df.columns
    assert drawn.count() == sum(r["copies"] for rs in rows.values() for r in rs)


def test_mixing_edge_rows(spark):
    df = docs(spark, [(1, None), (2, ""), (3, " \t\n"), (None, "a b"), (5, "x y   z"), (5, "x y   z")],
              sources=["a", None, "a", "a", None, None])
    df = df.withColumns({"size": F.lit(1), "row": F.lit("r"), "copies": F.lit(9), "h": F.lit(0)})
    rows = mixing.mix_plan(df, mixing.word_count("text")).collect()
    assert len(rows) == 6
    assert sorted(r["size"] for r in rows) == [0, 0, 0, 2, 3, 3]
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix_sources(df).columns == df.columns
    assert mixing.mix_sources(df.limit(0)).collect() == []
    blank = docs(spark, ["", None])
    assert [r["copies"] for r in mixing.mix_plan(blank, mixing.word_count("text")).collect()] == [0, 0]


def test_word_count_definition(spark):
    texts = ["a b", " a b ", "\x0b\x0c", "a\x1cb", " "]
    df = docs(spark, texts)
    got = {r[0]: r[1] for r in df.select("doc_id", mixing.word_count("text")).collect()}
    assert got == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in enumerate(texts)}


def shard_checks(rows, limit):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r["n_bytes"])
    for r in rows:
        assert r["shard_bytes"] == sum(by[r["shard"]]) and r["shard_docs"] == len(by[r["shard"]])
        assert r["shard_bytes"] <= limit or len(by[r["shard"]]) == 1
        assert r["oversize"] == (r["shard_bytes"] > limit)
    return by


def test_shards_fit_and_only_oversized_buckets_split(spark):
    rng = random.Random(5)
    texts = ["x" * rng.randint(0, 300) for _ in range(500)] + ["y" * 5000]
    rows = sharding.assign_shards(docs(spark, texts), limit=1000).collect()
    by = shard_checks(rows, 1000)
    assert len(rows) == 501 and sum(r["oversize"] for r in rows) == 1
    whole = Counter()
    for shard, sizes in by.items():
        for d in range(len(shard) + 1):
            whole[shard[:d]] += sum(sizes)
    assert all(whole[s[:-1]] > 1000 for s in by if s)  # the parent had to split
    assert not any(a != b and b.startswith(a) for a in by for b in by)


def test_shard_edge_rows(spark):
    same = [(7, "z" * 300)] * 10
    df = docs(spark, [(1, None), (None, "a"), (3, ""), *same]).withColumn("key", F.lit("k")).withColumn("slot", F.lit(1))
    rows = sharding.assign_shards(df, limit=1000, keep=["doc_id", "key", "slot"]).collect()
    by = shard_checks(rows, 1000)
    assert len(rows) == 13
    pages = [s for s in by if "-" in s]
    assert len(pages) == 4 and all(len(s.split("-")[0]) == 60 for s in pages)
    assert sharding.assign_shards(df.limit(0), limit=1000).collect() == []
    one = sharding.assign_shards(docs(spark, ["a", "b"]), limit=1000).collect()
    assert [(r["shard"], r["depth"]) for r in one] == [("", 0)] * 2
