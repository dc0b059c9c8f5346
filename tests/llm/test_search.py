import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpina.llm import search

from llm_helpers import docs

ITEMS = "item_id long, text string, doc_id string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(search.TERM, low)


def brute(texts, items, k=20):
    """Rankings by scoring every document for every item; texts are (doc_id, text)."""
    counts = [(d, Counter(terms(t))) for d, t in texts]
    counts = [(d, c) for d, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for d, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 6), st.integers(1, 40), st.integers(1, 9))
def test_interval_reading_finds_the_best_with_exact_scores(seed, n_lists, n_docs, k):
    rnd = random.Random(seed)
    total, lists = Counter(), []
    for _ in range(n_lists):
        held = rnd.sample(range(n_docs), rnd.randint(1, n_docs))
        scores = sorted((rnd.randint(1, 6) for _ in held), reverse=True)
        lists.append((np.array(held), np.array(scores, dtype=np.int64)))
        for d, s in zip(held, scores, strict=True):
            total[d] += s
    floor = rnd.randint(1, 8)
    depth, search.FIRST_DEPTH = search.FIRST_DEPTH, 1
    try:
        found, scores = search.by_intervals(lists, n_docs, k, floor)
    finally:
        search.FIRST_DEPTH = depth
    got = sorted(zip((-scores).tolist(), found.tolist(), strict=True))
    want = sorted((-s, d) for d, s in total.items() if s >= floor)
    assert all(total[d] == -s for s, d in got)
    assert [x for x in got if -x[0] >= floor][:k] == want[:k]
    if len(want) > k:  # whatever ties with the last place is there too
        assert {d for s, d in want if s <= want[k - 1][0]} <= {d for _, d in got}


def test_reading_stops_before_the_end_of_long_lists():
    n = 20_000
    lists = [(np.arange(n), np.r_[np.full(20, 10 ** 6), np.ones(n - 20)].astype(np.int64)) for _ in range(1)]
    found, scores = search.by_intervals(lists, n, 20, 1)
    assert sorted(found.tolist())[:20] == list(range(20)) and len(found) < 1000


WORDS = [f"w{i}" for i in range(60)] + ["The", "the", "Ünder", "İx", "日本", "a1b2", "x_y", "don't"]


def corpus(n, seed=1):
    rnd = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    return [(i, " ".join(rnd.choices(WORDS, weights, k=rnd.choice([1, 3, 8, 30, 90])))) for i in range(n)]


@pytest.mark.parametrize("shard", [1 << 14, 37])
def test_rankings_equal_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    texts = corpus(400)
    items = [(i, t) for i, (_, t) in enumerate(corpus(25, seed=2))] + [(90, "w1 w1 w1 the"), (91, "nowhere"), (92, "...")]
    got = search.ranked_search(docs(spark, texts, parts=5), spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS))
    assert rows(got) == brute(texts, items)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 20)
    texts, items = corpus(120), [(i, t) for i, (_, t) in enumerate(corpus(12, seed=3))]
    got = search.ranked_search(docs(spark, texts), spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS))
    assert rows(got) == brute(texts, items)


def test_edge_rows(spark):
    long = "needle " + "straw " * 200_000
    texts = [(None, "needle in hay"), (1, None), (2, ""), (3, "..."), (4, long), (5, "needle in hay"), (5, "needle in hay"), (6, "hay\x00needle\x7fin\nHAY")]
    texts += [(100 + i, "needle") for i in range(30)]
    items = [(1, "Needle hay"), (1, "Needle hay"), (1, "straw"), (None, "in"), (2, None), (3, "")]
    df = docs(spark, texts).withColumn("item_id", F.lit("x")).withColumn("score", F.lit(1))
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    assert rows(search.ranked_search(df, asked)) == brute(texts, [x for x in items if x[1]])
    assert rows(search.ranked_search(df.limit(0), asked)) == []
    assert rows(search.ranked_search(df, asked.limit(0))) == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_terms_follow_the_pattern(text):
    assert [t.decode() for t in search.terms_of(text)] == terms(text)
