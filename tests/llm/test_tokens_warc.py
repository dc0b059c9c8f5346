import base64
import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpina.llm import tokens, warc
from alpina.llm.common import table

from llm_helpers import docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())


def test_counts_equal_the_library_on_all_documents(spark, model):
    df = table(spark, SF, "documents")
    rows = tokens.count_tokens(df).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["n_tokens"] == len(model.encode(t))
        assert r["n_bytes"] == len(t.encode())
        assert r["over_limit"] == (r["n_tokens"] > 4096)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" ▁\t\n<s>/aebé 　"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pre_token_counts_add_up(text):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokens.model_path())
    assert tokens._count([text], {}, tokens.model_path()) == [len(sp.encode(text))]


def test_token_edge_rows(spark, model):
    long = "ab c" * 200_000 + "q" * 100_000
    special = "<s> </s> <unk> ▁▁ x  "
    df = docs(spark, [(1, None), (2, ""), (None, "a"), (4, long), (4, special), (4, special)])
    df = df.withColumn("n_tokens", F.lit("x")).withColumn("row", F.lit(1))
    rows = tokens.count_tokens(df).collect()
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows)
    n = len(model.encode(special))
    assert got == sorted([(1, 0, 0, False), (2, 0, 0, False), (0, 1, len(model.encode("a")), False),
                          (4, len(long), len(model.encode(long)), True)] + [(4, len(special.encode()), n, False)] * 2)
    assert tokens.count_tokens(df.limit(0)).collect() == []


PAGES = "page_id long, url string, html string, payload string"


def test_warc_round_trip_and_index(spark):
    rng = random.Random(1)
    html = ["<p>é</p>", "", None, "WARC/1.1\r\n\r\nx", "\r\n\r\n" * 3] + ["<b>" + "z" * rng.randint(0, 50) for _ in range(60)]
    rows = [(i, f"http://x/{i}?q=a b\n" if i % 7 else None, h, "clash") for i, h in enumerate(html)]
    pages = spark.createDataFrame(rows, PAGES).repartition(4)
    folder, index = warc.write_archive(pages.drop("payload"))
    spans = index.groupBy("file").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] for r in spans)  # records fill their files without gaps
    back = {r["page_id"]: r for r in warc.read_records(folder, index).collect()}
    first = {}
    for i, h in enumerate(html):
        first.setdefault(h or "", i)
    for i, h in enumerate(html):
        payload, r = (h or "").encode(), back[i]
        assert r["payload_bytes"] == len(payload)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        response = first[h or ""] == i
        assert (r["record_type"], r["refers_to"]) == (("response", None) if response else ("revisit", first[h or ""]))
        assert (r["payload"] is not None) == response and (not response or bytes(r["payload"]) == payload)
    picked = warc.read_records(folder, index.filter("page_id IN (3, 40)")).collect()
    assert sorted(r["page_id"] for r in picked) == [3, 40]


def test_archives_are_plain_gzip_members(spark):
    pages = spark.createDataFrame([(1, "u", "abc"), (2, "v", "abc")], "page_id long, url string, html string").coalesce(1)
    folder, index = warc.write_archive(pages)
    name = index.first()["file"]
    fs, root = warc._filesystem(folder)
    data = gzip.decompress(fs.open_input_file(f"{root}/{name}").read())
    assert data.count(b"WARC/1.1\r\n") == 2 and data.endswith(b"\r\n\r\n")
    assert b"WARC-Refers-To: " + warc.record_id(1).encode() in data


def test_warc_edge_rows(spark):
    rows = [(5, "a", "same", None), (3, "b", "same", None), (3, "b", "same", None), (None, "c", "same", None),
            (8, None, None, None), (9, None, "", None), (None, None, "alone", None)]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    got = sorted((r["page_id"] if r["page_id"] is not None else -1, r["payload_bytes"], r["record_type"], r["refers_to"])
                 for r in warc.warc_round_trip(pages).collect())
    assert got == [(-1, 4, "revisit", 3), (-1, 5, "response", None), (3, 4, "response", None), (3, 4, "response", None),
                   (5, 4, "revisit", 3), (8, 0, "response", None), (9, 0, "revisit", 8)]
    assert warc.warc_round_trip(pages.limit(0)).collect() == []


def test_ranges_merge_near_records_only():
    spans = [(0, 10), (10, 5), (100, 10), (100_000, 7), (100_007, 50)]
    assert warc.merged_ranges(spans, gap=100, most=1000) == [(0, 3, 110), (3, 5, 100_057)]
    assert warc.merged_ranges(spans, gap=0, most=12) == [(0, 1, 10), (1, 2, 15), (2, 3, 110), (3, 4, 100_007), (4, 5, 100_057)]
    assert warc.merged_ranges([]) == []


def test_reading_tasks_follow_the_archives_bytes(spark, monkeypatch):
    pages = spark.range(40).selectExpr("id AS page_id", "concat('u', id) AS url", "concat(id, repeat(sha2(CAST(id AS STRING), 256), 40)) AS html")
    folder, index = warc.write_archive(pages)
    total = index.agg(F.sum("length")).first()[0]
    monkeypatch.setattr(warc, "TASK_BYTES", -(-total // 6))
    back = warc.read_records(folder, index)
    assert back.rdd.getNumPartitions() == 6 and back.count() == 40
    long = spark.createDataFrame([(1, "u", "x" * 3_000_000), (2, "u", "x" * 3_000_000)], "page_id long, url string, html string")
    assert sorted((r["page_id"], r["payload_bytes"], r["refers_to"]) for r in warc.warc_round_trip(long).collect()) == [(1, 3000000, None), (2, 3000000, 1)]
