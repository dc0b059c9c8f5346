"""Token counts by a map-side two-tier lookup, without shuffling any pre-token.

No piece of the vocabulary has a space mark after another character (checked when the model is
loaded), so no merge crosses the start of a run of spaces, and the count of a text is the sum over its
pre-tokens (a run of spaces with the word after it). Tier 1 is a broadcast hash table from frequent
pre-tokens to their token counts. Tier 2 is a bounded cache per Python worker, filled by encoding the
misses with the library itself.

The frequent table comes from a bounded sample of the input and decides speed only, never a count:
at most ``SAMPLE_ROWS`` texts are looked at and ``TABLE_SIZE`` pre-tokens of at most ``KEY_CHARS``
characters are kept (a few MB, whatever the input size).

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings inside texts are
ordinary text; repeated rows and null ids keep their rows; an empty table gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import packed

MODEL = "piece_bpe_32k.model"
MAX_TOKENS = 4096
SAMPLE_ROWS = 2000
TABLE_SIZE = 50_000
KEY_CHARS = 32
CACHE_SIZE = 200_000
SPACE = "▁"

_models: dict[str, object] = {}
_caches: dict[str, dict[str, int]] = {}


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _model(path: str):
    """The worker's model, after a check that counts add up over pre-tokens."""
    if path not in _models:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError(f"{path}: pieces cross pre-token starts, counts do not add up")
        if sp.encode("a  b") == sp.encode("a b") or sp.encode(" a") == sp.encode("a"):
            raise ValueError(f"{path}: the model drops white space")
        _models[path] = sp
    return _models[path]


def pre_tokens(text: str) -> list[str]:
    """Words with the number of extra spaces before them: a text is cut before every space run.

    A single space (the usual case) is implied, so a key is the word itself; k further spaces stay
    in front of it; a key of spaces alone is the run that ends the text. The model puts a space mark
    before the text, so the first word has one too."""
    words = text.replace(SPACE, " ").split(" ")
    if "" not in words:
        return words
    out, extra = [], 0
    for w in words:
        if w:
            out.append(" " * extra + w)
            extra = 0
        else:
            extra += 1
    if extra:
        out.append(" " * extra)
    return out


def _encode(sp, keys: list[str]) -> list[int]:
    """Token counts of pre-tokens. The model adds one space mark to a text that isn't empty."""
    counts = [len(x) for x in sp.encode([k if k.strip(" ") else k[1:] for k in keys], num_threads=1)]
    return [1 if k == " " else n for k, n in zip(keys, counts, strict=True)]


def _count(texts: list[str], table: dict[str, int], path: str) -> list[int]:
    sp, cache = _model(path), _caches.setdefault(path, {})
    out = []
    for text in texts:
        if not text:
            out.append(0)
            continue
        total, misses = 0, Counter()
        for key, n in Counter(pre_tokens(text)).items():
            k = table.get(key)
            if k is None:
                k = cache.get(key)
            if k is None:
                misses[key] = n
            else:
                total += k * n
        if misses:
            keys = list(misses)
            if len(cache) + len(keys) > CACHE_SIZE:
                cache.clear()
            for key, k in zip(keys, _encode(sp, keys), strict=True):
                total += k * misses[key]
                if len(key) <= KEY_CHARS and len(cache) < CACHE_SIZE:
                    cache[key] = k
        out.append(total)
    return out


def frequent_table(texts: DataFrame, path: str, *, sample_rows: int = SAMPLE_ROWS,
                   size: int = TABLE_SIZE) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of a bounded sample of ``texts`` (one string column)."""
    t = texts.columns[0]
    words = F.explode(F.split(F.col(t), " "))
    rows = (texts.filter(F.col(t).isNotNull()).limit(sample_rows).select(words.alias("w"))
            .filter((F.length("w") > 0) & (F.length("w") <= KEY_CHARS) & ~F.col("w").contains(SPACE))
            .groupBy("w").count().orderBy(F.col("count").desc(), "w").limit(size).collect())
    keys = [r["w"] for r in rows]
    return dict(zip(keys, _encode(_model(path), keys), strict=True)) if keys else {}


def count_tokens(docs: DataFrame, *, text_col: str = "text", id_col: str = "doc_id",
                 path: str | None = None, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``max_tokens``) per row."""
    path = path or model_path()
    shared = docs.sparkSession.sparkContext.broadcast(frequent_table(docs.select(text_col), path))

    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_count(texts.tolist(), shared.value, path), dtype="int64")

    n_tokens = F.pandas_udf(tokens, "long")(F.coalesce(F.col(text_col), F.lit("")))
    counted = docs.select(packed(docs.select(id_col)),
                          F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
                          n_tokens.alias("n_tokens"))
    return counted.select(F.col(f"row.`{id_col}`").alias(id_col), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > max_tokens).alias("over_limit"))
