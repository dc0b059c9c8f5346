"""The registered queries of this subpackage, with DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alpina.llm import conversations, decontaminate, embeddings, mixing, near_dups, quality, search, secrets, sharding, suffix_dedup, token_files, tokens, warc
from alpina.llm.common import staged, table


def op1_embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark").select("text"))


def op8_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("words"))
    plan = mixing.mix_plan(staged(docs, "mix-words"), F.col("words"))
    return plan.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).alias("taken"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_round_trip(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damage(rows))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_embedding_near_dups": op1_embedding_near_dups,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_token_counts": op4_token_counts,
    "op5_warc": op5_warc,
    "op6_sharding": op6_sharding,
    "op7_secret_scan": op7_secret_scan,
    "op8_near_dups": op8_near_dups,
    "op9_mixing": op9_mixing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_token_files": op11_token_files,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INT)) & 31 AS INT), 1)), '')
           AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first AND first IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM f
""",
    "op6_sharding": """
WITH d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, '')), 1, 15) AS BIGINT) AS key
  FROM documents),
levels AS (SELECT unnest(range(0, 25)) AS depth),
nodes AS (
  SELECT depth, key >> CAST(60 - depth AS INT) AS prefix, sum(n_bytes) AS shard_bytes, count(*) AS shard_docs
  FROM d, levels GROUP BY 1, 2),
fit AS (
  SELECT doc_id, n_bytes, key, depth, shard_bytes, shard_docs,
         row_number() OVER (PARTITION BY key, doc_id ORDER BY depth) AS rn
  FROM d JOIN nodes ON prefix = key >> CAST(60 - depth AS INT) AND (shard_bytes <= 1048576 OR shard_docs = 1))
SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE substr(lpad(bin(key), 60, '0'), 1, CAST(depth AS INT)) END AS shard,
       CAST(depth AS INT) AS depth, CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_docs,
       shard_bytes > 1048576 AS oversize
FROM fit WHERE rn = 1
""",
    "op9_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) * 3 AS BIGINT) AS cap,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM d GROUP BY source),
l AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS full_at,
         CAST(sum(source_size) OVER () - sum(cap) OVER w + cap AS DOUBLE)
           / sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s WINDOW w AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t AS (
  SELECT source, source_size,
         CASE WHEN level > full_at THEN CAST(cap AS DOUBLE)
              ELSE weight * max(CASE WHEN NOT level > full_at THEN level END) OVER () END AS target,
         CAST(CAST('0x' || substr(md5('mix-1:' || coalesce('s:' || source, 'n')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u
  FROM l),
r AS (
  SELECT doc_id, size, source_size, target, u, target / source_size AS rate,
         row_number() OVER (PARTITION BY d.source, size > 0 ORDER BY size, h) AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0
            ELSE size * least(CAST(floor(u + rate * rank) - floor(u + rate * (rank - 1)) AS BIGINT), 3) END AS taken
FROM r
""",
    "op12_conversation_repair": r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
crcs AS (
  SELECT k, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(k, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]),
                             lambda x, y: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))), CAST(4294967295 AS BIGINT)) % 20 AS kind
  FROM (SELECT DISTINCT k FROM keyed) AS u),
copies AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed JOIN crcs USING (k) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos FROM copies),
faulty AS (
  SELECT conv_id, turn, role, text, pos, left(role, 1) AS ini,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS last
  FROM faulty GROUP BY conv_id),
nexts(s, t, added) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
inserts AS (
  SELECT s, s AS t, 0 AS c, '' AS a, '' AS x FROM nexts
  UNION ALL SELECT s, t, 3, 'I', chr(10) || added || ':' FROM nexts
  UNION ALL SELECT n.s, m.t, 6, 'II', chr(10) || n.added || ':' || chr(10) || m.added || ':' FROM nexts n JOIN nexts m ON n.t = m.s),
edits(s, ini, e, c, t) AS (
  SELECT s, '*', 'D', 4, s FROM nexts
  UNION ALL SELECT s, '*', 'R', 3, t FROM nexts
  UNION ALL SELECT * FROM (VALUES (0, 's', 'K', 0, 1), (0, 'u', 'K', 0, 2), (1, 'u', 'K', 0, 2), (2, 'a', 'K', 0, 3), (3, 'u', 'K', 0, 2)) AS k),
moves AS (
  SELECT i.s, e.ini, e.e, i.c + e.c AS c, e.t, i.a || e.e AS a, i.x,
         CASE WHEN e.e = 'R' AND e.t = 2 THEN 'user' WHEN e.e = 'R' THEN 'assistant' END AS renamed
  FROM inserts i JOIN edits e ON i.t = e.s),
search AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS s, struct_pack(c := CAST(0 AS BIGINT), a := '', x := '') AS way FROM counts
  UNION ALL
  SELECT f.conv_id, f.pos, m.t, min(struct_pack(
      c := CAST(r.way.c + m.c + CASE WHEN f.fault = 'truncated' AND m.e <> 'D' THEN 3 ELSE 0 END AS BIGINT), a := r.way.a || m.a,
      x := r.way.x || m.x || CASE WHEN m.e = 'D' THEN '' ELSE chr(10) || coalesce(m.renamed, f.role) || ':' || f.text END))
  FROM search r JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.pos + 1
  JOIN moves m ON m.s = r.s AND (m.ini = '*' OR m.ini = f.ini) AND (m.e = 'D' OR f.fault NOT IN ('blank', 'duplicate'))
  GROUP BY f.conv_id, f.pos, m.t),
best AS (
  SELECT r.conv_id, min(struct_pack(c := r.way.c + i.c, a := r.way.a || i.a, x := r.way.x || i.x)) AS way
  FROM search r JOIN counts n ON n.conv_id IS NOT DISTINCT FROM r.conv_id AND n.last = r.pos
  JOIN inserts i ON i.s = r.s AND i.t IN (0, 3)
  GROUP BY r.conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.way.c, 0) AS cost, coalesce(b.way.a, '') AS audit,
       sha256(coalesce(substr(b.way.x, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS i
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
""",
    "op13_ranked_search": r"""
WITH held AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents) AS t
  GROUP BY doc_id, term),
lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
factors AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // terms) AS m FROM lengths, totals),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) AS t
  GROUP BY item_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, totals WHERE term IN (SELECT term FROM asked) GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN factors USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0) AS r
WHERE rank <= 20
""",
}
