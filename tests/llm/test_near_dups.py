import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alpina.llm import buckets, embeddings, near_dups
from alpina.llm.alignment import edit_distances
from alpina.llm.components import components
from alpina.llm.words import word_hashes

from llm_helpers import docs


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def roots(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_banded_distances_equal_full_ones():
    rng = random.Random(1)
    a, b = [], []
    for _ in range(300):
        x = [rng.randint(0, 5) for _ in range(rng.randint(0, 70))]
        y = list(x)
        for _ in range(rng.randint(0, 40)):
            p = rng.randint(0, len(y))
            y[p:p + rng.randint(0, 1)] = [rng.randint(0, 5)] * rng.randint(0, 1)
        a.append(np.array(x, dtype=np.int64))
        b.append(np.array(y, dtype=np.int64))
    limits = np.array([rng.choice([0, 3, 17, 40, 100]) for _ in a])
    want = [min(plain_distance(x, y), n + 1) for x, y, n in zip(a, b, limits)]
    assert edit_distances(a, b, limits).tolist() == want


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 3), (61, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for pair in links for x in pair}
    assert got == {i: r for i, r in roots(ids, links).items() if i != 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def edited(rng, words, rate):
    out = list(words)
    for _ in range(int(len(words) * rate)):
        p = rng.randrange(len(out))
        out[p:p + rng.randint(0, 1)] = [f"new{rng.randint(0, 10**6)}"] * rng.randint(0, 1)
    return out


def corpus(rng):
    texts = []
    for _ in range(40):
        base = [f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([30, 80, 300]))]
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 3])):
            texts.append(" ".join(edited(rng, base, 0.03)))
    shared = [f"s{i}" for i in range(40)]  # one passage in many documents links nothing
    texts += [" ".join([f"u{rng.randint(0, 10**6)}" for _ in range(60)] + shared) for _ in range(40)]
    return texts


@pytest.mark.parametrize("block", [1024, 4])
def test_groups_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", block)
    rng = random.Random(9)
    texts = corpus(rng) + [" ".join(edited(rng, [f"hot{i}" for i in range(90)], 0.04)) for _ in range(30)]
    texts += [texts[0], texts[0].upper() + " ..."]
    words = [word_hashes(t).view(np.int64) for t in texts]
    links = []
    for i in range(len(texts)):
        longest = np.array([max(len(words[i]), len(w)) for w in words[:i]], dtype=np.int64)
        limit = np.floor(longest * 0.2 + 1e-9).astype(np.int64)
        d = edit_distances([words[i]] * i, words[:i], limit)
        links += [(i, int(j)) for j in np.flatnonzero(d <= limit)]
    want = roots(range(len(texts)), links)
    rows = near_dups.near_duplicates(docs(spark, texts)).collect()
    assert {r["doc_id"]: r["group_id"] for r in rows} == want
    assert all(r["kept"] == (r["doc_id"] == r["group_id"]) for r in rows)
    assert len({r["class_id"] for r in rows}) == len(set(texts))


def test_near_dup_edge_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    df = docs(spark, [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "one two"), (6, "one two"),
                      (None, "left alone without an id"), (None, "left alone without an id"), (8, long), (9, long + " x")])
    df = df.withColumn("id", F.lit(1)).withColumn("fp", F.lit("f")).withColumn("row", F.lit(0)).withColumn("group_id", F.lit(0))
    kept = near_dups.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect())
    assert ids == [(False, 1), (False, 3), (False, 4), (False, 8), (True, 0)]
    assert near_dups.near_duplicates(df.limit(0)).collect() == []
    assert near_dups.drop_near_duplicates(df.limit(0)).collect() == []


def test_hadamard_keeps_lengths_and_hashes_are_stable():
    x = np.random.default_rng(0).normal(size=(20, 64))
    assert np.allclose(np.linalg.norm(embeddings.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    a, b = embeddings.hash_vectors(x), embeddings.hash_vectors(x[:5])
    assert (a[0][:5] == b[0]).all() and (a[1][:5] == b[1]).all()
    assert a[0].shape == (20, embeddings.TABLES * embeddings.PROBES)


def vectors(rng, n=400):
    out = []
    for i in range(n):
        v = rng.normal(size=16)
        out.append(v)
        for _ in range(rng.choice([0, 0, 1, 3])):
            out.append(v + rng.normal(size=16) * rng.choice([0.02, 0.05, 0.08]))
        if i % 40 == 0:
            out += [v] * 3 + [v * 7.5]
    hub = rng.normal(size=16)
    return out + [hub + rng.normal(size=16) * 0.03 for _ in range(60)]


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(buckets, "BLOCK", block)
    x = [np.float32(v) for v in vectors(np.random.default_rng(3))]
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int").repartition(4)
    u = np.array(x, dtype=float)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = roots(range(len(x)), zip(*(p.tolist() for p in np.nonzero(near))))
    rows = embeddings.near_duplicates(df).collect()
    exact = sum(r["n_links"] == near[r["vec_id"]].sum() and r["component_id"] == want[r["vec_id"]] for r in rows)
    assert len(rows) == len(x) and exact >= 0.995 * len(x)
    assert all(r["n_links"] <= near[r["vec_id"]].sum() for r in rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)


def test_embedding_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]),
            (9, [1.0, 0.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (12, [3e38, 0.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(5)).withColumn("key", F.lit("k"))
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in embeddings.near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([(0, 0, 0, True), (1, 2, 1, True), (2, 2, 1, False), (12, 2, 1, False), (10, 1, 10, True), (11, 1, 10, False), *alone])
    assert embeddings.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("block", [1024, 1])
def test_every_candidate_between_components_is_tried(spark, block, monkeypatch):
    """The best pair of the groups 1, 2 and 3, 4 fails, a pair far below it links; 5 links only with 6, at the least score."""
    monkeypatch.setattr(buckets, "BLOCK", block)
    tops = {1: 0, 2: 4, 3: 0, 4: 9}
    sketches = {i: bytes([0] * (24 - n) + [i] * n) for i, n in tops.items()} | {5: bytes([5] * 24), 6: bytes([5] * 8 + [6] * 16)}
    links = {(1, 2), (3, 4), (2, 4), (5, 6)}
    rows = spark.createDataFrame([(i, [7] if i < 5 else [8], bytearray(s), 10) for i, s in sketches.items()],
                                 "id long, keys array<long>, sketch binary, size int")
    tried = []

    def verify(pairs):
        got = [(r["a"], r["b"]) for r in pairs.collect()]
        tried.extend(got)
        return spark.createDataFrame([p for p in got if p in links], "a long, b long")

    got = buckets.linked_components(rows, verify, buckets.shared_bytes, 8)
    assert {r["id"]: r["component"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5}
    assert len(tried) == len(set(tried)) <= 7


@pytest.mark.parametrize("block", [1024, 1])
def test_candidates_tried_where_they_meet(spark, block, monkeypatch):
    """As above, with the last round in place: 1, 2 and 3, 4 come together over 2, 4."""
    monkeypatch.setattr(buckets, "BLOCK", block)
    tops = {1: 0, 2: 4, 3: 0, 4: 9}
    sketches = {i: bytes([0] * (24 - n) + [i] * n) for i, n in tops.items()} | {5: bytes([5] * 24), 6: bytes([5] * 8 + [6] * 16)}
    links = {(1, 2), (3, 4), (2, 4), (5, 6)}
    rows = spark.createDataFrame([(i, [7, 17] if i < 5 else [8], bytearray(s), 10) for i, s in sketches.items()],
                                 "id long, keys array<long>, sketch binary, size int")

    def verify(pairs):
        return spark.createDataFrame([p for p in ((r["a"], r["b"]) for r in pairs.collect()) if p in links], "a long, b long")

    exact = buckets.Exact(lambda ids: ids.select("id", F.col("id").cast("string").cast("binary").alias("data")), lambda c: [int(x) for x in c],
                          lambda a, b: np.array([(min(p), max(p)) in links for p in zip(a, b)]))
    got = buckets.linked_components(rows, verify, buckets.shared_bytes, 8, exact=exact,
                                    more_links=spark.createDataFrame([(6, 99)], "a long, b long"))
    assert {r["id"]: r["component"] for r in got.collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 99: 5}


def test_texts_that_share_most_of_themselves_are_candidates_but_no_links(spark):
    rng = random.Random(6)
    common = [f"c{i}" for i in range(300)]
    texts = [" ".join(common + [f"own{rng.randint(0, 10 ** 6)}" for _ in range(100)]) for _ in range(60)]
    texts += [" ".join(common + t.split()[300:390] + ["z"] * 10) for t in texts[:3]]  # links of the first three
    group = {r["doc_id"]: r["group_id"] for r in near_dups.near_duplicates(docs(spark, texts)).collect()}
    assert group == {i: i - 60 if i >= 60 else i for i in range(63)}


def test_shared_words_bound_the_edits():
    rng = random.Random(7)
    for _ in range(300):
        a, b = (word_hashes(" ".join(rng.choice("abcde") for _ in range(rng.randint(0, 30)))) for _ in range(2))
        with np.errstate(over="ignore"):
            x, y = near_dups.Words(a), near_dups.Words(b)
        from collections import Counter
        assert x.shared(y) == sum((Counter(a.tolist()) & Counter(b.tolist())).values())
        assert max(len(a), len(b)) - x.shared(y) <= plain_distance(a.tolist(), b.tolist())


@pytest.mark.parametrize("rows", [
    [(1, "A"), (5, "A"), (5, "B"), (9, "B")], [(5, "B"), (9, "B"), (5, "A"), (1, "A"), (1, "C")], [(2, "B"), (2, "A"), (2, None), (3, "C")],
    [(None, "A"), (7, "A"), (7, "B"), (None, "B"), (None, None)]])
def test_texts_of_one_id_are_one_group_whose_head_survives(spark, rows):
    words = {x: " ".join(f"{x}{i}" for i in range(30)) for x in "ABC"}
    df = docs(spark, [(i, words.get(t)) for i, t in rows]).withColumn("fp", F.lit("x"))
    group = {r["doc_id"]: r for r in near_dups.near_duplicates(df).collect()}
    links, texts = [], {}
    ident = {}
    for r in near_dups.near_groups(df).collect():
        ident[r["id"]] = r["group_id"]
    for n, (i, t) in enumerate(rows):
        texts.setdefault(t, []).append(n)
    for same in texts.values():
        links += [(same[0], x) for x in same]
    for n, (i, _) in enumerate(rows):
        links += [(m, n) for m, (j, _) in enumerate(rows[:n]) if i is not None and i == j]
    want = roots(range(len(rows)), links)
    for n, (i, _) in enumerate(rows):
        for m, (j, _) in enumerate(rows):
            if i is not None and j is not None:
                assert (group[i]["group_id"] == group[j]["group_id"]) == (want[n] == want[m])
    heads = {g for g in ident.values()}
    assert all(group[h]["kept"] for h in heads)
    kept = [tuple(r) for r in near_dups.drop_near_duplicates(df).collect()]
    assert len(kept) == len(heads) == len(set(want.values()))
    again = [tuple(r) for r in near_dups.drop_near_duplicates(df.repartition(7)).collect()]
    assert sorted(kept, key=str) == sorted(again, key=str)


def test_tables_written_on_the_way_are_gone(spark):
    from alpina.session import list_dir, scratch_path
    folder = scratch_path(spark, "x").rsplit("/", 1)[0]
    before = set(list_dir(spark, folder))
    near_dups.near_duplicates(docs(spark, ["a b c d e f g h", "a b c d e f g h", "i j"])).collect()
    left = set(list_dir(spark, folder)) - before
    assert len(left) == 1 and next(iter(left)).startswith("omh-groups")


def replaced(rng, words, rate):
    """``rate`` of the words replaced at scattered places."""
    out = list(words)
    for p in rng.sample(range(len(out)), int(len(out) * rate + 1e-9)):
        out[p] = f"new{rng.randint(0, 10**9)}"
    return out


def test_links_up_to_a_fifth_of_edits_are_found(spark):
    rng = random.Random(4)
    texts, rates = [], []
    for n in (10, 20, 40, 100, 300):
        for rate in (0.1, 0.15, 0.2, 0.3):
            for _ in range(25):
                base = [f"w{rng.randint(0, 30_000)}" for _ in range(n)]
                texts += [" ".join(base), " ".join(replaced(rng, base, rate))]
                rates.append(rate)
    group = {r["doc_id"]: r["group_id"] for r in near_dups.near_duplicates(docs(spark, texts)).collect()}
    found = [group[2 * i] == group[2 * i + 1] for i in range(len(rates))]
    assert not any(f for f, rate in zip(found, rates) if rate == 0.3)
    for rate in (0.1, 0.15, 0.2):
        assert np.mean([f for f, r in zip(found, rates) if r == rate]) >= 0.99, rate


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_groups_around_the_limit(spark, block, monkeypatch):
    """Clusters whose pairs lie at cosine 0.94 to 0.96, where sign bits cannot rank the links."""
    monkeypatch.setattr(buckets, "BLOCK", block)
    rng = np.random.default_rng(11)
    x = []
    for _ in range(120):
        centre = rng.normal(size=64)
        centre /= np.linalg.norm(centre)
        for _ in range(rng.integers(3, 9)):
            off = rng.normal(size=64)
            off -= (off @ centre) * centre
            x.append(centre + off / np.linalg.norm(off) * np.sqrt(1 / rng.uniform(0.945, 0.953) - 1))
    u = np.array(x)
    u /= np.linalg.norm(u, axis=1)[:, None]
    near = u @ u.T >= 0.95
    np.fill_diagonal(near, False)
    want = roots(range(len(x)), zip(*(p.tolist() for p in np.nonzero(near))))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = embeddings.near_duplicates(df).collect()
    wrong = sum(r["component_id"] != want[r["vec_id"]] or r["n_links"] != near[r["vec_id"]].sum() for r in rows)
    assert len(rows) == len(x) and wrong <= 0.005 * len(x), (wrong, len(x))
