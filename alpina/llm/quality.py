"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into overlapping chunks that cover all of it. In a chunk every window of
``WIDTH`` bytes passes learned filters, ReLU keeps what fires and the largest response of each filter is
kept. A byte enters as its learned embedding and one fixed channel, its echo: whether the ``GRAM`` bytes
that start there also stand up to ``ECHO`` bytes before (filters alone cannot see repetition). The document's features are the mean and the maximum of its
chunks' responses, combined by a logistic layer into one probability.

The network is fitted on the driver from at most ``TRAIN_ROWS`` labelled texts per class, whole, of at most
``TRAIN_CHARS`` characters in all (both bounds are parameters; the choice is by hash, so reruns agree; where the sum goes beyond
the bound the longest of the chosen texts are left out).
Scoring reads whole texts, in the map tasks, with the weights (a few kB) broadcast.

Defined results: null and empty texts are one chunk of padding and get a score like any other; null ids
and repeated rows keep their rows; without labelled rows of both classes every score is the share of
label 1 (0.5 without labels); an empty table gives an empty table. Extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alpina.llm.common import packed, unpacked

CHUNK = 512
STRIDE = 448
WIDTH = 6
EMBED = 8
GRAM = 4
ECHO = 20
CHANNELS = EMBED + 1
FILTERS = 24
THRESHOLD = 0.7
TRAIN_ROWS = 700
TRAIN_CHARS = 4_000_000
SHORT_CUT = 128
EPOCHS = 14
BATCH = 32
SEED = 11
PAD = 256
SYMBOLS = 257
BLOCK_CHUNKS = 128


def chunks_of(data: bytes) -> np.ndarray:
    """(chunks, CHUNK) symbols: byte, or PAD after the end; plus SYMBOLS where the byte is an echo."""
    n = max(1, -(-max(0, len(data) - CHUNK) // STRIDE) + 1)
    flat = np.full((n - 1) * STRIDE + CHUNK, PAD, dtype=np.int64)
    flat[:len(data)] = np.frombuffer(data, dtype=np.uint8)
    if len(data) > GRAM:
        gram = np.ndarray(len(data) - GRAM + 1, np.uint32, data, 0, (1,))
        echo = np.zeros(len(gram), dtype=bool)
        for lag in range(GRAM - 1, min(ECHO + 1, len(gram))):
            echo[lag:] |= gram[lag:] == gram[:-lag]
        flat[:len(gram)] += SYMBOLS * echo
    return np.lib.stride_tricks.sliding_window_view(flat, CHUNK)[::STRIDE]


def _embedded(w: dict[str, np.ndarray], chunks: np.ndarray) -> np.ndarray:
    table = np.zeros((2 * SYMBOLS, CHANNELS), dtype=w["embed"].dtype)
    table[:SYMBOLS, :EMBED] = table[SYMBOLS:, :EMBED] = w["embed"]
    table[SYMBOLS:, EMBED] = 1
    return table[chunks]


def _windows(x: np.ndarray) -> np.ndarray:
    """(chunks, positions, WIDTH * CHANNELS) from embedded chunks (chunks, CHUNK, CHANNELS)."""
    n, c, e = x.shape
    s = x.strides
    return np.lib.stride_tricks.as_strided(x, (n, c - WIDTH + 1, WIDTH * e), (s[0], s[1], s[2]), writeable=False)


def start_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return {"embed": rng.normal(0, 0.5, (SYMBOLS, EMBED)), "filters": rng.normal(0, 1 / np.sqrt(WIDTH * CHANNELS), (WIDTH * CHANNELS, FILTERS)),
            "bias": np.zeros(FILTERS), "out": rng.normal(0, 0.1, 2 * FILTERS), "out_bias": np.zeros(1)}


def _pooled(w: dict[str, np.ndarray], chunks: np.ndarray) -> np.ndarray:
    """Largest filter responses per chunk, after ReLU."""
    out = np.empty((len(chunks), FILTERS), dtype=np.float32)
    for s in range(0, len(chunks), BLOCK_CHUNKS):
        x = _embedded(w, chunks[s:s + BLOCK_CHUNKS])
        flat = np.ascontiguousarray(_windows(x)).reshape(-1, WIDTH * CHANNELS)
        out[s:s + BLOCK_CHUNKS] = (flat @ w["filters"]).reshape(len(x), -1, FILTERS).max(axis=1)
    return np.maximum(out + w["bias"], 0)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[bytes], labels: list[int], prior: float = 0.5) -> dict[str, np.ndarray]:
    """Weights from labelled texts: logistic loss with balanced classes, Adam, back-propagation through
    the windows that won the pooling. ``prior`` (share of label 1 among all labels) then moves the bias
    half of the way to its log odds: a document is rejected only on evidence."""
    y = np.array(labels, dtype=float)
    share = float(y.mean()) if len(y) else 0.5
    w = start_weights()
    if share in (0.0, 1.0) or not len(y):
        w["out"][:] = 0
        w["out_bias"][:] = np.log((share + 1e-3) / (1 - share + 1e-3)) if len(y) else 0
        return w
    rng = np.random.default_rng(SEED)
    docs, y = _training_set(texts, y, rng)
    balance = float(y.mean())
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v2 = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    for epoch in range(EPOCHS):
        for part in np.array_split(rng.permutation(len(docs)), max(1, len(docs) // BATCH)):
            step += 1
            g = _gradients(w, [docs[i] for i in part], y[part], balance)
            rate = 0.01 * (1 - epoch / EPOCHS) + 0.001
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v2[k] = 0.999 * v2[k] + 0.001 * g[k] ** 2
                w[k] = w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.999 ** step)) + 1e-8)
    w["out_bias"] = w["out_bias"] + np.log(prior / (1 - prior)) / 2
    return w


def _training_set(texts: list[bytes], y: np.ndarray, rng) -> tuple[list[np.ndarray], np.ndarray]:
    """Chunks of every text and of one short cut of it with its label, by the same rule for both labels (so short
    texts are judged by what they hold, not by their length)."""
    docs, marks = [], []
    for t, label in zip(texts, y, strict=True):
        docs.append(chunks_of(t))
        n = int(np.exp(rng.uniform(np.log(SHORT_CUT), np.log(CHUNK))))
        if n < len(t):
            at = int(rng.integers(0, len(t) - n))
            docs.append(chunks_of(t[at:at + n]))
            marks += [label]
        marks += [label]
    return docs, np.array(marks)


def _responses(w, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest response of each filter in each chunk, after ReLU, and the window it comes from."""
    pooled, at = np.empty((len(chunks), FILTERS)), np.empty((len(chunks), FILTERS), dtype=np.int64)
    for s in range(0, len(chunks), BLOCK_CHUNKS):
        z = np.ascontiguousarray(_windows(_embedded(w, chunks[s:s + BLOCK_CHUNKS]))) @ w["filters"]
        at[s:s + BLOCK_CHUNKS] = z.argmax(axis=1)
        pooled[s:s + BLOCK_CHUNKS] = z.max(axis=1)
    return np.maximum(pooled + w["bias"], 0), at


def _gradients(w, docs: list[np.ndarray], y: np.ndarray, share: float) -> dict[str, np.ndarray]:
    chunks = np.concatenate(docs)
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    pooled, at = _responses(w, chunks)
    n = np.bincount(owner, minlength=len(docs))[:, None]
    mean = np.zeros((len(docs), FILTERS))
    np.add.at(mean, owner, pooled)
    mean /= n
    top = np.zeros((len(docs), FILTERS))
    np.maximum.at(top, owner, pooled)
    p = _sigmoid(np.concatenate([mean, top], axis=1) @ w["out"] + w["out_bias"][0])
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    dz = (p - y) * weight / len(y)
    g = {"out": np.concatenate([mean, top], axis=1).T @ dz + 1e-3 * w["out"], "out_bias": np.array([dz.sum()])}
    largest = pooled == top[owner]  # a window where chunks overlap can be the largest of both
    ties = np.zeros((len(docs), FILTERS))
    np.add.at(ties, owner, largest)
    d_pool = (dz[:, None] * w["out"][:FILTERS] / n)[owner] + (dz[:, None] * w["out"][FILTERS:] / ties)[owner] * largest
    d_pool *= pooled > 0
    g["bias"] = d_pool.sum(axis=0)
    g["filters"], g["embed"] = 1e-4 * w["filters"], np.zeros_like(w["embed"])
    for s in range(0, len(chunks), BLOCK_CHUNKS):  # only the winning windows are built again
        part, d = chunks[s:s + BLOCK_CHUNKS], d_pool[s:s + BLOCK_CHUNKS]
        won = part[np.arange(len(part))[:, None, None], at[s:s + BLOCK_CHUNKS, :, None] + np.arange(WIDTH)]  # (chunks, filters, WIDTH)
        g["filters"] += np.einsum("cfk,cf->kf", _embedded(w, won).reshape(len(part), FILTERS, -1), d)
        d_win = d[:, :, None] * w["filters"].T[None]  # (chunks, filters, WIDTH * CHANNELS)
        np.add.at(g["embed"], (won % SYMBOLS).ravel(), d_win.reshape(-1, CHANNELS)[:, :EMBED])
    return g


def score_texts(w: dict[str, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Probability of label 1 for whole texts; a long text is pooled block by block."""
    out = np.empty(len(texts))
    i = 0
    while i < len(texts):
        group, size = [], 0
        while i + len(group) < len(texts) and (not group or size < BLOCK_CHUNKS):
            group.append(chunks_of(texts[i + len(group)]))
            size += len(group[-1])
        pooled = _pooled(w, np.concatenate(group))
        ends = np.cumsum([len(c) for c in group])
        starts = ends - [len(c) for c in group]
        mean = np.add.reduceat(pooled, starts, axis=0) / (ends - starts)[:, None]
        top = np.maximum.reduceat(pooled, starts, axis=0)
        out[i:i + len(group)] = _sigmoid(np.concatenate([mean, top], axis=1) @ w["out"] + w["out_bias"][0])
        i += len(group)
    return out


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", rows: int = TRAIN_ROWS,
          chars: int = TRAIN_CHARS) -> dict[str, np.ndarray]:
    """Fit on at most ``rows`` labelled texts of each class that are not held out, of ``chars`` characters in all, chosen by hash."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter(
        "id IS NOT NULL AND y IN (0, 1)").filter(~held_out("id")).groupBy("id").agg(F.min("y").alias("y"))
    order = F.xxhash64("id")
    chosen = marks.filter("y = 0").orderBy(order, "id").limit(rows).unionByName(
        marks.filter("y = 1").orderBy(order, "id").limit(rows))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # at most 2 * rows ids; the bound on characters keeps what the driver holds independent of the texts' lengths
    found = (docs.select(F.col(id_col).alias("id"), text.alias("text")).filter(F.length("text") <= chars).join(F.broadcast(chosen), "id")
             .groupBy("id").agg(F.min("y").alias("y"), F.min("text").alias("text")))
    shortest = Window.orderBy(F.length("text"), F.xxhash64("id"), "id")
    taken = (found.withColumn("sum", F.sum(F.length("text")).over(shortest)).filter(F.col("sum") <= chars)
             .orderBy(F.xxhash64("id"), "id").collect())
    n, good = marks.agg(F.count(F.lit(1)), F.sum("y")).first()
    w = fit([r["text"].encode() for r in taken], [r["y"] for r in taken], (good + 1) / (n + 2) if n else 0.5)
    return {k: v.astype(np.float32) for k, v in w.items()}


def with_score(docs: DataFrame, weights: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(shared.value, [t.encode() for t in texts]))

    return docs.select(packed(docs), F.pandas_udf(score, "double")(F.coalesce(F.col(text_col), F.lit(""))).alias("score"))


def classify(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per row."""
    weights = train(docs, labels, id_col=id_col, text_col=text_col)
    scored = with_score(docs.select(id_col, text_col), weights, text_col)
    return scored.select(F.col(f"row.`{id_col}`").alias(id_col), held_out(f"row.{id_col}").alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least THRESHOLD."""
    weights = train(docs, labels, id_col=id_col, text_col=text_col)
    return unpacked(with_score(docs, weights, text_col).filter(F.col("score") >= THRESHOLD), docs.columns)
