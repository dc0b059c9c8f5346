"""Secret scan: a random forest removes false positives among candidate strings. DataFrame functions only.

Candidates are runs of at least ``LEAST`` key characters; ``=`` counts only as padding at the end, so in KEY=value the
name and the value are runs of their own. Where a candidate is a name that the next one is assigned to, it stands in
``before`` of that one. A value shorter than ``LEAST`` is no candidate, with or without its name. Each is described by its length, its class
transitions (letter case, digit, sign), entropy, how much of it ordinary words cover (share of its letter
triples that occur in a word list; at most 26^3 entries, held in one literal), the path it was found at, and the
words before and after it. Spark ML trains the forest on labelled findings (``label`` 1: a secret) and
scores all candidates.

Without a table of labelled findings, ``weak_labels`` makes one from the documents outside the
held-out quarter (crc32 of the id mod 4 is 2): a value assigned to a credential's name is a secret, any other
candidate is not. At most ``TRAIN_FINDINGS`` per class are used, chosen by hash.

Defined results: null and empty texts have no candidates; a null path is an empty one; null ids and repeated
rows keep their findings; long texts are scanned whole; with one class of labels only every score is
that class; an empty table gives an empty table. Extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alpina.llm.common import staged

LEAST = 16
CANDIDATE = r"(?<![\p{L}\p{N}+/_-])(?:[A-Za-z0-9+/_-]{16,}={0,2}|[A-Za-z0-9+/_-]{15}=|[A-Za-z0-9+/_-]{14}==)(?![\p{L}\p{N}])"
#: between a name and the value assigned to it; a name's own run may have taken the sign along
ASSIGNS, ASSIGNS_REST, TOOK_SIGN = r"^[\"']?\s{0,8}[=:]\s{0,8}[\"']?$", r"^\s{0,8}[\"']?$", r"[^=]=$"
BEFORE, AFTER = 48, 24
TRAIN_FINDINGS = 20_000
TREES, DEPTH, SEED = 24, 8, 5
THRESHOLD = 0.5
CREDENTIAL = r"(?i)(token|secret|passw|pwd|api|key|auth|bearer|credential)"
DIGEST = r"(?i)(sha|md5|hash|digest|commit|checksum|uuid|rev)"
TEST_PATH = r"(?i)(test|example|fixture|sample|mock|doc)"
ASSIGNED = r"(?i)(token|secret|passw\w*|pwd|key|auth\w*|bearer|credentials?)[\"']?\s*[=:]\s*[\"']?$"
FEATURES = ["length", "transitions", "transition_share", "digit_share", "upper_share", "sign_share", "entropy",
            "word_cover", "in_path", "test_path", "credential_before", "digest_before", "assigned", "quoted",
            "words_before", "words_after"]


def findings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: ``doc_id``, ``finding_no``, ``path``, ``before``, ``candidate``, ``after``.

    The text between candidates is what splitting at them leaves, so both arrays line up."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"), text.alias("text"))
    cut = (rows.filter(F.col("text").rlike(CANDIDATE))
           .withColumn("found", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)))
           .withColumn("between", F.transform(F.split("text", CANDIDATE, -1), lambda x: F.struct(
               F.substring(x, 1, AFTER).alias("head"), F.substr(x, F.greatest(F.length(x) - BEFORE + 1, F.lit(1)), F.lit(BEFORE)).alias("tail")))))
    cut = cut.withColumn("found", F.transform("found", lambda c, i: F.struct(c.alias("candidate"), F.get("found", i - 1).alias("name"))))
    candidate, name, tail = F.col("f.candidate"), F.col("f.name"), F.get("between", F.col("finding_no"))["tail"]
    assigned = name.isNotNull() & (tail.rlike(ASSIGNS) | (name.rlike(TOOK_SIGN) & tail.rlike(ASSIGNS_REST)))
    return (cut.select("doc_id", "path", "between", F.posexplode("found").alias("finding_no", "f"))
            .select("doc_id", "finding_no", "path", F.when(assigned, F.right(F.concat(name, tail), F.lit(BEFORE))).otherwise(tail).alias("before"),
                    candidate.alias("candidate"), F.coalesce(F.get("between", F.col("finding_no") + 1)["head"], F.lit("")).alias("after")))


def word_triples(words: DataFrame) -> Column:
    """Which letter triples occur in a column of prose: a literal array of '0' and '1' over 26^3 places."""
    t = words.columns[0]
    word = F.explode(F.regexp_extract_all(F.lower(F.coalesce(F.col(t), F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0)))
    triple = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 2), lambda i: F.substr("w", i, F.lit(3))))
    seen = {r["g"] for r in words.select(word.alias("w")).select(triple.alias("g")).distinct().collect()}
    letters = "abcdefghijklmnopqrstuvwxyz"
    return F.split(F.lit("".join("1" if a + b + c in seen else "0" for a in letters for b in letters for c in letters)), "")


def _share(c: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(c, pattern, "")) / F.length(c)


def _word_cover(c: Column, triples: Column) -> Column:
    code = lambda g, k: F.ascii(F.substring(g, k, 1)) - 97

    def known(g):
        a, b, d = code(g, 1), code(g, 2), code(g, 3)
        letters = (F.least(a, b, d) >= 0) & (F.greatest(a, b, d) < 26)
        return F.when(letters & (F.get(triples, (a * 26 + b) * 26 + d) == "1"), 1.0).otherwise(0.0)

    # all overlapping triples in one pass, so a very long candidate costs its length
    values = F.transform(F.regexp_extract_all(F.lower(c), F.lit("(?=(...))"), F.lit(1)), known)
    return F.aggregate(values, F.lit(0.0), lambda x, y: x + y) / (F.length(c) - 2)


def with_features(found: DataFrame, triples: Column) -> DataFrame:
    c = F.col("candidate")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    runs = F.length(F.regexp_replace(classes, r"(.)\1+", "$1"))
    chars = F.array_distinct(F.split(c, ""))
    share = F.transform(chars, lambda x: (F.length(c) - F.length(F.replace(c, x, F.lit("")))) / F.length(c))
    entropy = F.aggregate(share, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    yes = lambda x: F.coalesce(x, F.lit(False)).cast("double")
    made = {
        "length": F.length(c).cast("double"), "transitions": (runs - 1).cast("double"), "transition_share": runs / F.length(c),
        "digit_share": _share(c, "[^0-9]"), "upper_share": _share(c, "[^A-Z]"), "sign_share": _share(c, "[A-Za-z0-9]"),
        "entropy": entropy, "word_cover": _word_cover(c, triples),
        "in_path": yes(F.col("before").rlike(r"[/.\\]\w*$") | F.col("after").rlike(r"^[/.]\w") | c.contains("/")),
        "test_path": yes(F.col("path").rlike(TEST_PATH)), "credential_before": yes(F.col("before").rlike(CREDENTIAL)),
        "digest_before": yes(F.col("before").rlike(DIGEST)), "assigned": yes(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "quoted": yes(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")),
        "words_before": F.regexp_count("before", F.lit(r"\p{L}{2,}")).cast("double"),
        "words_after": F.regexp_count("after", F.lit(r"\p{L}{2,}")).cast("double"),
    }
    return found.withColumns(made)


def weak_labels(described: DataFrame) -> DataFrame:
    """Labelled findings of the documents that are not held out."""
    c = F.col("candidate")
    secret = F.col("before").rlike(ASSIGNED) & c.rlike("[0-9]") & c.rlike("[A-Za-z]")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))
    return described.filter(~held_out).withColumn("label", secret.cast("double"))


def score(described: DataFrame, labelled: DataFrame, *, rows: int = TRAIN_FINDINGS) -> DataFrame:
    """``described`` with ``score``: the forest's probability that a candidate is a secret."""
    order = [F.xxhash64("candidate", "before"), "candidate", "before"]
    chosen = staged(labelled.filter("label = 1").orderBy(*order).limit(rows).unionByName(
        labelled.filter("label = 0").orderBy(*order).limit(rows)).select("label", *FEATURES), "secret-findings")
    kinds = [r["label"] for r in chosen.select("label").distinct().collect()]
    if len(kinds) < 2:
        return described.withColumn("score", F.lit(float(kinds[0]) if kinds else 0.5))
    vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label")
    model = forest.fit(vector.transform(chosen))
    scored = model.transform(vector.transform(described))
    return scored.select(*described.columns, vector_to_array("probability")[1].alias("score"))


def scan(docs: DataFrame, words: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source",
         labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate with its score; ``masked`` shows four characters of it, ``sha256`` names it.

    ``words``: one column of ordinary prose. ``labelled``: findings (as ``findings`` makes them) with ``label``."""
    triples = word_triples(words)
    found = staged(with_features(findings(docs, id_col=id_col, text_col=text_col, path_col=path_col), triples), "secret-candidates")
    marks = weak_labels(found) if labelled is None else with_features(labelled, triples)
    out = score(found, marks)
    return out.select(F.col("doc_id").alias(id_col), "finding_no", F.sha2("candidate", 256).alias("sha256"),
                      F.concat(F.substring("candidate", 1, 4), F.lit("...")).alias("masked"), F.length("candidate").alias("length"),
                      "score", (F.col("score") >= THRESHOLD).alias("is_secret"))
