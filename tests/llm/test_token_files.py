import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpina.llm import token_files as tf
from alpina.llm.common import table
from alpina.llm.warc import _filesystem

from llm_helpers import docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(tf.tokenizer_path())


def expected(library, rows):
    """(doc_id, start, n_tokens, crc) of rows (doc_id, text) in their order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def by_start(df):
    return sorted((tuple(r) for r in df.select("doc_id", "start", "n_tokens", "ids_crc32").collect()), key=lambda r: r[1])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2 ** 64 - 1)), max_size=700))
def test_elias_fano_keeps_every_value(values):
    values = sorted(values)
    ef = tf.EliasFano.of(np.array(values, dtype=np.uint64))
    again = tf.EliasFano(ef.n, ef.width, *ef.sections())
    assert again.values().tolist() == values
    assert [again[i] for i in range(len(values))] == values
    with pytest.raises(IndexError):
        again[len(values)]


@pytest.mark.parametrize("gap", [1, 40, 1000, 100_000])
def test_boundaries_take_near_minimal_space(gap):
    rnd = np.random.default_rng(gap)
    ends = np.cumsum(rnd.integers(1, 2 * gap + 1, 50_000))
    bits = 8 * sum(map(len, tf.EliasFano.of(ends).sections())) / len(ends)
    assert bits < 2 + max(0, np.log2(ends[-1] / len(ends))) + 0.5 < 64


def test_select_crosses_long_gaps():
    values = [0] * 300 + [5] * 300 + [2 ** 40] * 300 + list(range(2 ** 40, 2 ** 40 + 300))
    ef = tf.EliasFano.of(np.array(values, dtype=np.uint64))
    assert [ef[i] for i in range(len(values))] == values


TEXTS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t'sde1.<|>é 　\x1c日२"), st.characters(exclude_categories=["Cs"])), max_size=60)


@settings(max_examples=600, deadline=None)
@given(TEXTS)
def test_pieces_give_the_library_s_ids(text):
    encoder = tf._encoder(tf.tokenizer_path())
    for t in (text, text.replace("<", "<|endoftext|>"), f"don't  we'll {text}'s  x"):
        assert np.frombuffer(encoder.encode(t), dtype=encoder.dtype).tolist() == encoder.library.encode(t, add_special_tokens=False).ids


def test_caches_change_nothing(library):
    encoder = tf.Encoder(tf.tokenizer_path())
    for cache in (encoder.starts, encoder.spaced, encoder.bare):
        cache.size = 5
    rnd = random.Random(2)
    for _ in range(300):
        t = " ".join(rnd.choice(["one", "two,", "three\nfour", "x" * 80, "日本", "a.b"]) + str(rnd.randint(0, 9)) for _ in range(20))
        assert np.frombuffer(encoder.encode(t), dtype="<u2").tolist() == library.encode(t, add_special_tokens=False).ids
    assert max(len(c.known) for c in (encoder.starts, encoder.spaced, encoder.bare)) <= 25


def test_round_trip_equals_the_library(spark, library):
    df = table(spark, SF, "documents")
    rows = sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    assert by_start(tf.token_round_trip(df.repartition(5))) == expected(library, rows)


def test_many_files_and_tasks(spark, library, monkeypatch):
    monkeypatch.setattr(tf, "FILE_IDS", 40)
    monkeypatch.setattr(tf, "FILE_DOCS", 3)
    monkeypatch.setattr(tf, "READ_BYTES", 24)
    monkeypatch.setattr(tf, "FILE_BLOCK", 2)
    rnd = random.Random(1)
    rows = [(i * 7 - 300, " ".join(rnd.choices(["alpha", "beta", "gamma,"], k=rnd.choice([0, 1, 5, 60])))) for i in range(120)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder, manifest = tf.write_token_files(docs(spark, rows, parts=6))
        assert by_start(tf.read_token_files(folder, manifest)) == expected(library, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted((r.asDict() for r in manifest.collect()), key=lambda r: (r["part"], r["number"]))
    assert len({r["part"] for r in files}) > 3 and max(r["n_docs"] for r in files) <= 3
    fs, root = _filesystem(folder)
    seen = []
    for r in files:
        with tf.TokenFile(fs, f"{root}/{r['file']}") as f:
            assert (len(f), f.footer["n_ids"]) == (r["n_docs"], r["n_ids"])
            seen += [(d, f.document(i).tolist()) for i, d in enumerate(f.doc_ids()[0].tolist())]
    assert seen == [(d, [*library.encode(t, add_special_tokens=False).ids, 2]) for d, t in rows]


def test_edge_rows(spark, library):
    long = "ab c\n" * 60_000 + "q" * 50_000
    rows = [(-2 ** 63, "first"), (1, None), (2, ""), (3, long), (4, "<|endoftext|> x <|endoftext|>"), (2 ** 63 - 1, "last"), (None, "none"), (None, None)]
    df = docs(spark, rows).withColumn("start", F.lit("x")).withColumn("part", F.lit(None).cast("int"))
    got = by_start(tf.token_round_trip(df))
    assert got[:6] == expected(library, rows[:6])
    assert sorted(r[2:] for r in got[6:]) == sorted(r[2:] for r in expected(library, rows[6:])) and {r[0] for r in got[6:]} == {None}
    same = docs(spark, [(7, "a"), (7, "b c"), (7, "b c"), (7, None)])
    assert sorted(r[2:] for r in by_start(tf.token_round_trip(same))) == sorted(r[2:] for r in expected(library, [(7, t) for t in ("a", "b c", "b c", "")]))
    assert by_start(tf.token_round_trip(same)) == by_start(tf.token_round_trip(same.repartition(1)))
    assert tf.token_round_trip(df.limit(0)).collect() == []


def test_other_files_are_refused(tmp_path):
    (tmp_path / "x").write_bytes(b"0" * 100)
    with pytest.raises(ValueError):
        tf.TokenFile(*_filesystem(str(tmp_path / "x")))
