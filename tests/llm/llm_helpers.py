DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, *, sources=None, parts=3, first=0):
    """A documents table; ids from ``first`` unless a text is given as (id, text)."""
    rows = []
    for i, t in enumerate(texts):
        d, t = t if isinstance(t, tuple) else (first + i, t)
        rows.append((d, t, "en", sources[i] if sources else "s", len(t or "")))
    return spark.createDataFrame(rows, DOC_SCHEMA).repartition(parts)
