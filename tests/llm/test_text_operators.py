import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from alpina.llm import anchors, decontaminate, deep_shallow, quality, secrets, suffix_dedup
from alpina.llm.common import table

from llm_helpers import docs

SF = "/root/testdata/sf0.01"


# decontamination


def norm(t):
    return " ".join(t.lower().split())


def best_fit(item, text):
    """Fewest edits between the item and any part of the text (full table)."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_passages_equal_brute_force():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 30)))) for i in range(12)]
    index = decontaminate.build_index(items)
    for _ in range(60):
        i, item = rng.choice(items)
        part = list(item)
        for _ in range(rng.randint(0, int(len(item) * 0.12))):
            p = rng.randrange(len(part))
            part[p:p + rng.randint(0, 1)] = [rng.choice("abcdefghij ")] * rng.randint(0, 1)
        text = " ".join(word() for _ in range(30)) + " " + "".join(part).title() + "\n" + " ".join(word() for _ in range(20))
        got = {h[0]: h for h in decontaminate.find_passages(index, text)}
        for j, other in items:
            least = best_fit(norm(other), norm(text))
            assert (j in got) == (least <= int(len(norm(other)) * decontaminate.EDIT_RATE))
            if j in got:
                assert got[j][3] == least
                assert abs(len(text[got[j][1]:got[j][2]]) - len(other)) <= least + 4


@pytest.mark.parametrize("length", [11, 16, 17, 18, 19, 20, 33, 34, 40])
def test_short_passages_equal_brute_force(length):
    rng = random.Random(length)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqr") for _ in range(n))
    items = [(i, letters(length)) for i in range(4)]
    index = decontaminate.build_index(items)
    for n in range(80):
        i, item = rng.choice(items)
        p = rng.randrange(length)
        part = [item, item[:p] + "z" + item[p + 1:], item[:p] + item[p + 1:], item[:p] + "zz" + item[p:]][n % 4]
        text = letters(rng.randint(0, 30)) + part + letters(rng.randint(0, 30))
        got = {h[0]: h[3] for h in decontaminate.find_passages(index, text)}
        for j, other in items:
            least = best_fit(other, text)
            assert got.get(j) == (least if least <= int(length * decontaminate.EDIT_RATE) else None)


def test_items_beyond_a_million_characters():
    rng = np.random.default_rng(1)
    item = "".join(map(chr, rng.integers(97, 123, (1 << 20) + 500)))
    index = decontaminate.build_index([(7, item), (8, item[:100])])
    assert {(h[0], h[3]) for h in decontaminate.find_passages(index, item)} == {(7, 0), (8, 0)}
    assert {h[0] for h in decontaminate.find_passages(index, "x " + item[:5000])} == {8}


def test_leaks_in_the_tables(spark):
    d, b = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    texts = {r["doc_id"]: r["text"] or "" for r in d.collect()}
    items = [norm(r["text"]) for r in b.collect()]
    want = {k for k, t in texts.items() if any(i in norm(t) for i in items)}
    got = {r["doc_id"] for r in decontaminate.leaked_passages(d, b).collect()}
    assert want and got == want
    assert {r["doc_id"] for r in decontaminate.drop_leaked(d, b).select("doc_id").collect()} == set(texts) - want


def test_decontamination_edge_rows(spark, monkeypatch):
    leak = "the quick brown fox jumps over the lazy dog and runs away"
    df = docs(spark, [(1, None), (2, ""), (3, "x " * 50_000 + leak.upper() + " y" * 10), (None, leak), (5, leak), (5, leak), (6, "the quick")])
    df = df.withColumn("item_id", F.lit(1)).withColumn("row", F.lit(2))
    bench = spark.createDataFrame([(1, leak, 0), (1, leak, 0), (2, None, 0), (3, "", 0), (4, "the quick", 0)], "item_id long, text string, doc_id int")
    hits = decontaminate.leaked_passages(df, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"], r["edits"]) for r in hits) == sorted([(i, 1, 0) for i in (0, 3, 5, 5)] * 2)
    kept = decontaminate.drop_leaked(df, bench)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 6]
    assert decontaminate.leaked_passages(df.limit(0), bench).collect() == []
    assert decontaminate.leaked_passages(df, bench.limit(0)).collect() == []
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 40)  # several broadcast blocks
    assert sorted(map(str, decontaminate.leaked_passages(df, bench).collect())) == sorted(map(str, hits))


# quality


def test_held_out_quality(spark):
    d, lab = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = {r["doc_id"]: r for r in quality.classify(d, lab).collect()}
    assert len(rows) == d.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows.values())
    marks = [(r["quality"], rows[r["doc_id"]]["predicted"]) for r in lab.collect() if rows[r["doc_id"]]["held_out"]]
    assert sum(a == b for a, b in marks) / len(marks) >= 0.95
    again = {r["doc_id"]: r["score"] for r in quality.classify(d.repartition(5), lab).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-6 for i, r in rows.items())


def test_scores_equal_brute_force(spark):
    """Every window of every chunk of a text, one by one in plain Python, against the blocked scorer in tasks."""
    rng = random.Random(9)
    texts = ["", "abc", "déjà vu " * 3, "".join(rng.choice("ab cé") for _ in range(700)), "word " * 260, "x" * 1025]
    w = quality.start_weights()
    w["bias"], w["out_bias"] = w["bias"] - 0.3, np.array([0.4])

    def plain(text):
        data = text.encode()
        chunks, start = [], 0
        while True:
            chunks.append((start, [data[start + i] if start + i < len(data) else quality.PAD for i in range(quality.CHUNK)]))
            if start + quality.CHUNK >= len(data):
                break
            start += quality.STRIDE
        grams = [data[i:i + quality.GRAM] for i in range(max(0, len(data) - quality.GRAM + 1))] if len(data) > quality.GRAM else []
        echo = [any(grams[i - lag] == g for lag in range(quality.GRAM - 1, min(quality.ECHO, i) + 1)) for i, g in enumerate(grams)]
        pooled = []
        for start, chunk in chunks:
            x = [[*w["embed"][b], float(start + i < len(echo) and echo[start + i])] for i, b in enumerate(chunk)]
            wins = [np.concatenate(x[i:i + quality.WIDTH]) for i in range(quality.CHUNK - quality.WIDTH + 1)]
            pooled.append([max(0.0, max(float(v @ w["filters"][:, f]) for v in wins) + w["bias"][f]) for f in range(quality.FILTERS)])
        z = sum(o * v for o, v in zip(w["out"], [*np.mean(pooled, axis=0), *np.max(pooled, axis=0)])) + w["out_bias"][0]
        return 1 / (1 + np.exp(-z))

    df = docs(spark, list(enumerate(texts)))
    got = {r["row"]["doc_id"]: r["score"] for r in quality.with_score(df, w).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(plain(t), abs=1e-5), i


def test_training_reads_whole_texts_within_the_bound(spark, monkeypatch):
    df = docs(spark, [(1, "good " * 400), (3, "bad! " * 2000), (4, "bad? " * 300), (5, "fine " * 5)])
    lab = spark.createDataFrame([(1, 1), (3, 0), (4, 0), (5, 1)], "doc_id long, quality int")
    ids = [i for i in (1, 3, 4, 5) if zlib.crc32(str(i).encode()) % 4 != 2]
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, y, prior: seen.append((sorted(map(len, texts)), prior)) or quality.start_weights())
    size = {1: 2000, 3: 10000, 4: 1500, 5: 25}
    quality.train(df, lab)
    quality.train(df, lab, chars=5000)
    assert seen[0][0] == sorted(size[i] for i in ids) and seen[1][0] == sorted(size[i] for i in ids if size[i] < 5000)


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(i % 251 for i in range(n))
        c = quality.chunks_of(data) % quality.SYMBOLS
        flat = np.full((len(c) - 1) * quality.STRIDE + quality.CHUNK, quality.PAD)
        for i, x in enumerate(c):
            flat[i * quality.STRIDE:i * quality.STRIDE + quality.CHUNK] = x
        assert bytes(flat[:n].astype(np.uint8)) == data and (flat[n:] == quality.PAD).all()


def test_gradients_equal_differences():
    rng = np.random.default_rng(1)
    w = quality.start_weights()
    parts = [quality.chunks_of(bytes(rng.integers(97, 110, n, dtype=np.uint8))) for n in (700, 90, 40)]
    y = np.array([1.0, 0.0, 1.0])

    def loss(w):
        z = []
        for c in parts:
            p = np.maximum((np.ascontiguousarray(quality._windows(quality._embedded(w, c))) @ w["filters"]).max(axis=1) + w["bias"], 0)
            z.append(np.r_[p.mean(axis=0), p.max(axis=0)] @ w["out"] + w["out_bias"][0])
        p = 1 / (1 + np.exp(-np.array(z)))
        weight = np.where(y == 1, 0.5 / 0.6, 0.5 / 0.4)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean() + 5e-4 * (w["out"] ** 2).sum() + 5e-5 * (w["filters"] ** 2).sum()

    g = quality._gradients(w, parts, y, 0.6)
    for k in w:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        assert g[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-6, rel=1e-3)


def test_quality_edge_rows(spark):
    df = docs(spark, [(1, None), (2, ""), (None, "good text"), (4, "x" * 200_000), (5, "a b"), (5, "a b")])
    df = df.withColumn("score", F.lit("s")).withColumn("row", F.lit(1)).withColumn("y", F.lit(3))
    lab = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 0, 1), (5, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(df, lab).collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.keep_good(df, lab).columns == df.columns
    assert {r["score"] for r in quality.classify(df, lab.limit(0)).collect()} == {0.5}
    assert quality.classify(df.limit(0), lab).collect() == []
    assert all(r["score"] > 0.9 for r in quality.classify(df, lab.filter("quality = 1")).collect())


# suffix dedup


def brute_removal(rows, length):
    """Remaining bytes and removed runs per row, windows in order of document and place."""
    seen, out = set(), []
    for text in rows:
        b = text.encode()
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if w in seen:
                cover[i:i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, c in zip(b, cover) if not c)
        runs = sum(1 for i in range(len(b)) if cover[i] and not (i and cover[i - 1]))
        out.append((len(b), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


@settings(max_examples=120, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=40), min_size=1, max_size=8), st.integers(9, 40), st.sampled_from([1, 2, 4]))
def test_deep_shallow_groups(parts, length, symbols):
    data = b"".join(p * 3 for p in parts) + b"".join(parts) + bytes(64)
    starts = np.arange(len(data) - max(length, 40))
    old = deep_shallow.SHALLOW, deep_shallow.SMALL
    deep_shallow.SHALLOW, deep_shallow.SMALL = symbols, 8
    try:
        order, group = deep_shallow.equal_groups(np.frombuffer(data, dtype=np.uint8), starts, length)
    finally:
        deep_shallow.SHALLOW, deep_shallow.SMALL = old
    got = {}
    for s, g in zip(order.tolist(), group.tolist()):
        got.setdefault(g, []).append(s)
    want = {}
    for s in starts.tolist():
        want.setdefault(data[s:s + length], []).append(s)
    assert sorted(map(sorted, got.values())) == sorted(v for v in want.values() if len(v) > 1)
    keys = [data[v[0]:v[0] + length] for _, v in sorted(got.items())]
    assert keys == sorted(keys)


def test_equal_windows_share_their_anchor():
    rng = random.Random(6)
    shared = bytes(rng.choice(b"abcd ") for _ in range(300))
    texts = [bytes(rng.choice(b"abcd ") for _ in range(rng.randint(0, 400))) + shared[rng.randint(0, 50):rng.randint(160, 300)] for _ in range(20)]
    starts = np.r_[0, np.cumsum([len(t) for t in texts])]
    with np.errstate(over="ignore"):
        text, first, count, anchor, cover = anchors.segments(np.frombuffer(b"".join(texts), dtype=np.uint8), starts, 100)
    by_window, covers, seen = {}, {}, [0] * len(texts)
    for t, f, n, a, c in zip(text, first, count, anchor, cover):
        seen[t] += n
        for s in range(f, f + n):
            assert by_window.setdefault(texts[t][s:s + 100], a) == a
        assert covers.setdefault((a, c), texts[t][f:f + n + 99]) == texts[t][f:f + n + 99]
    assert seen == [max(0, len(t) - 99) for t in texts]


@pytest.mark.parametrize("block,piece", [(4096, 1 << 22), (2, 150)])
def test_removal_equals_brute_force(spark, block, piece, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    monkeypatch.setattr(suffix_dedup, "SORTED_AT_ONCE", 3000)
    rng = random.Random(8)
    passage = "".join(rng.choice("abc dé") for _ in range(260))
    texts = []
    for _ in range(40):
        own = "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 300)))
        cut = passage[rng.randint(0, 60):rng.randint(120, 260)]
        texts.append(own + cut + own[:rng.randint(0, 300)])
    texts += [texts[3], "ab" * 400, "z" * 500, "short", ""]
    rng.shuffle(texts)
    rows = sorted(suffix_dedup.remove_repeats(docs(spark, texts)).collect(), key=lambda r: r["doc_id"])
    want = brute_removal(texts, 100)
    assert [tuple(r)[1:5] for r in rows] == want
    assert all(hashlib.sha256(bytes(r["kept"])).hexdigest() == r["kept_sha256"] for r in rows)


def test_pieces_hold_every_window_once(monkeypatch):
    monkeypatch.setattr(anchors, "PIECE", 50)
    for n in (0, 99, 100, 149, 150, 260):
        data = bytes(range(250))[:n] + bytes(max(0, n - 250))
        windows = [at + i for at, p in suffix_dedup._pieces(data, 100) for i in range(len(p) - 99)]
        assert windows == list(range(max(0, n - 99)))


def test_suffix_edge_rows(spark):
    a, b = "a1b2c3d4e5" * 12, "q9w8e7r6t5" * 13
    df = docs(spark, [(1, None), (2, ""), (3, a), (3, a), (4, a + b), (None, b), (None, b), (None, a), (5, "x" * 99)])
    df = df.withColumn("id", F.lit(1)).withColumn("tie", F.lit(2)).withColumn("kept", F.lit("k"))
    rows = suffix_dedup.remove_repeats(df).collect()
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in rows))
    assert [g[:3] for g in got] == [(False, 1, 0), (False, 2, 0), (False, 3, 120), (False, 4, 250), (False, 5, 99), (True, 0, 120), (True, 0, 130)]
    removed = {g[:3]: g[3] for g in got}
    assert removed[False, 3, 120] == 110 and removed[False, 4, 250] >= 120 and removed[True, 0, 130] == 130 and removed[True, 0, 120] == 120
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []


# secrets


def test_secret_scan_on_held_out_documents(spark):
    d, words = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "benchmark").select("text")
    held = d.filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    secret = F.size(F.regexp_extract_all("text", F.lit(r'(?i)token = "[0-9a-f]{40}"'), F.lit(0)))
    truth = {r["doc_id"]: r["n"] for r in held.select("doc_id", secret.alias("n")).collect()}
    rows = [r for r in secrets.scan(d, words).collect() if r["doc_id"] in truth]
    found = {}
    for r in rows:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["is_secret"]
    assert sum(truth.values()) > 20
    assert {k: v for k, v in found.items() if v} == {k: v for k, v in truth.items() if v}


def test_findings_and_features(spark):
    text = 'sha1 0123456789abcdef0123 and token = "AbCd1234EfGh5678IjKl" in /etc/keys/some-long-name-here.txt'
    found = secrets.findings(docs(spark, [(1, text)])).orderBy("finding_no").collect()
    assert [r["candidate"] for r in found] == ["0123456789abcdef0123", "AbCd1234EfGh5678IjKl", "/etc/keys/some-long-name-here"]
    assert found[1]["before"] == ' and token = "' and found[1]["after"] == '" in '
    words = spark.createDataFrame([("some long name here",)], "text string")
    rows = secrets.with_features(secrets.findings(docs(spark, [(1, text)])), secrets.word_triples(words)).orderBy("finding_no").collect()
    assert [r["digest_before"] for r in rows] == [1.0, 0.0, 0.0]
    assert [r["assigned"] for r in rows] == [0.0, 1.0, 0.0] and [r["quoted"] for r in rows] == [0.0, 1.0, 0.0]
    assert rows[2]["word_cover"] > 0.2 > rows[0]["word_cover"] and rows[2]["in_path"] == 1.0
    assert rows[1]["transitions"] == 13 and rows[0]["digit_share"] == pytest.approx(14 / 20)


def test_secret_edge_rows(spark):
    key = "Zx81Kq0Wm2Nv93Lp7Tt5"
    df = docs(spark, [(1, None), (2, ""), (None, f'key = "{key}"'), (4, f'key = "{key}"'), (4, f'key = "{key}"'), (5, "aaaa" * 50_000), (6, key)],
              sources=[None, "s", "s", None, None, "s", "s"]).withColumn("label", F.lit(9.0)).withColumn("length", F.lit("x"))
    words = spark.createDataFrame([("plain words",), (None,)], "text string")
    rows = secrets.scan(df, words).collect()
    assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["is_secret"] == (r["score"] >= 0.5) for r in rows)
    assert secrets.scan(df.limit(0), words).collect() == []
    assert {r["score"] for r in secrets.scan(df.filter("doc_id = 6"), words).collect()} <= {0.0, 0.5}
    labelled = secrets.findings(df).withColumn("label", F.when(F.col("before").contains("key"), 1.0).otherwise(0.0))
    got = secrets.scan(df, words.limit(0), labelled=labelled).collect()
    assert sorted(r["is_secret"] for r in got) == [False, False, True, True, True]


def test_secrets_of_unquoted_assignments(spark):
    key, hexa = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY", "0123456789abcdef0123456789abcdef01234567"
    padded = "dGhpcyBpcyBhIHNlY3JldCE="
    texts = [f"token={hexa}", f"AWS_SECRET_ACCESS_KEY={key}", f"export DATABASE_PASSWORD={padded}\n", f"see https://a.org/?access_token={hexa}&page=2",
             f'AWS_SECRET_ACCESS_KEY="{key}"', f"aws_secret_access_key = {key}", f'"aws_secret_access_key": "{key}"', f"x {hexa} {key}", "0123456789abcd=="]
    values = [hexa, key, padded, hexa, key, key, key, None, None]
    found = secrets.findings(docs(spark, texts))
    rows = {(r["doc_id"], r["candidate"]): r["before"] for r in found.collect()}
    assert (8, "0123456789abcd==") in rows and not rows[7, key].strip()
    one_id = found.withColumn("text_no", F.col("doc_id")).withColumn("doc_id", F.lit(0))  # an id that is not held out
    labels = {(r["text_no"], r["candidate"]): r["label"] for r in secrets.weak_labels(one_id).collect()}
    words = spark.createDataFrame([("plain words",)], "text string")
    described = {(r["doc_id"], r["candidate"]): r for r in secrets.with_features(found, secrets.word_triples(words)).collect()}
    for i, value in enumerate(values[:7]):
        row = described[i, value]
        assert row["assigned"] == 1 and row["credential_before"] == 1, texts[i]
        assert labels[i, value] == 1, texts[i]
    assert described[7, key]["assigned"] == 0 and labels[7, key] == 0
