from collections import Counter

import corpus_pipeline as cp
import pytest
from alpina.llm import decontaminate, mixing, near_dups, quality
from alpina.llm.common import staged, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        after = staged(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_stage_columns_and_names(stages):
    assert [n for n, *_ in stages] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_decisions_take_effect(spark, stages):
    rows = {n: (Counter(r["doc_id"] for r in b.collect()), Counter(r["doc_id"] for r in a.select("doc_id").collect())) for n, b, a in stages}
    docs = {n: b for n, b, _ in stages}
    scores = {r["doc_id"]: r["predicted"] for r in quality.classify(docs["quality"], table(spark, SF, "labels")).collect()}
    assert set(rows["quality"][1]) == {i for i in rows["quality"][0] if scores[i]}
    kept = {r["doc_id"] for r in near_dups.near_duplicates(docs["near_duplicates"]).collect() if r["kept"]}
    assert set(rows["near_duplicates"][1]) == kept
    leaked = {r["doc_id"] for r in decontaminate.leaked_passages(docs["decontamination"], table(spark, SF, "benchmark")).collect()}
    assert set(rows["decontamination"][1]) == set(rows["decontamination"][0]) - leaked
    plan = mixing.mix_plan(docs["mixing"], mixing.word_count("text")).select("row.doc_id", "copies").collect()
    assert rows["mixing"][1] == Counter({r["doc_id"]: r["copies"] for r in plan if r["copies"]})
    assert rows["sharding"][1] == rows["mixing"][1]


def test_run_returns_the_last_stage(spark, stages):
    key = lambda r: (r["doc_id"], r["shard"])
    assert sorted(map(key, cp.run(spark, SF).collect())) == sorted(map(key, stages[-1][2].collect()))


def test_stages_take_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, SF).collect() == []
