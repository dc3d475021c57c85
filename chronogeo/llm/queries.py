"""One query per operator over the whole of its table, and the same in SQL where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronogeo.llm import (
    best_fit, chat, decontaminate, exact, jaccard, line_dedup, orchard, packing, quality, ranked_search, sharding, substring, token_counts)
from chronogeo.llm.tables import read
from chronogeo.session import scratch_root

SHARD_BYTES = 64 << 20
END_OF_TEXT = 49407  # of word_bpe_49k.json
PROBE = "\\### Assistant: </turn> ok"


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer; only the operators that encode need the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(read(spark, sf_dir, "documents"), run=2, stats=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents"), SHARD_BYTES)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as flat token files in the shared folder, then counted from these files alone."""
    path = f"{scratch_root(spark)}/chronogeo/{uuid.uuid4().hex}"
    token_counts.write_token_files(read(spark, sf_dir, "documents"), tokenizer(), END_OF_TEXT, path)
    return token_counts.count_tokens(spark, path, END_OF_TEXT).select(
        F.regexp_extract("file", r"part-(\d+)", 1).cast("int").alias("file"), "doc", "start", "n_tokens", "closed")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.mark_copies(read(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    # Conversations in three layouts that keep roles as they are; to_json makes no record of another one.
    content = F.struct("role", F.col("text").alias("content"))
    layouts = [F.struct("role", "text"), content, F.struct(F.array(content).alias("messages"))]
    texts = [F.to_json(x, {"ignoreNullFields": "false"}) for x in layouts]
    kind = F.pmod(F.xxhash64("conv_id"), F.lit(len(texts)))
    record = F.when(kind == 0, texts[0]).when(kind == 1, texts[1]).otherwise(texts[2])
    records = rows.unionByName(probe).select("conv_id", "turn", record.alias("record"))
    return chat.read_back(chat.format_turns(chat.canonical_turns(records)))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(read(spark, sf_dir, "embeddings"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_sharding, op3_substring_dedup, op4_quality, op5_token_counts, op6_packing, op7_exact_dedup,
    op8_decontamination, op9_chat_formatting, op10_ngram_jaccard, op11_ranked_search, op12_centroid_clustering, op13_best_fit_packing)}

_SPACE = r"[^\x20\x09-\x0D]+"

ORACLE = {
    "op1_line_dedup": r"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, text IS NULL AS none FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM raw),
filled AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM lines
  WHERE NOT regexp_full_match(line, '[\x20\x09-\x0D]*')),
pairs AS (SELECT a.doc_id, a.i AS i1, b.i AS i2, a.line AS l1, b.line AS l2
  FROM filled a JOIN filled b ON a.doc_id = b.doc_id AND b.k = a.k + 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY l1, l2 ORDER BY doc_id, i1) AS r FROM pairs),
gone AS (SELECT doc_id, i1 AS i FROM ranked WHERE r > 1 UNION SELECT doc_id, i2 FROM ranked WHERE r > 1),
kept AS (SELECT l.doc_id, count(*) AS n, count(g.i) AS out, string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL) AS t
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id)
SELECT r.doc_id, CASE WHEN none THEN 0 ELSE n END AS n_lines, out AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM raw r JOIN kept k ON r.doc_id = k.doc_id""",
    "op2_sharding": f"""
WITH r AS (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h,
  coalesce(strlen(text), 0)::BIGINT AS n_bytes FROM documents),
sums AS (SELECT d, h >> (60 - d)::BIGINT AS p, sum(n_bytes) AS b, count(*) AS c FROM r, range(0, 31) g(d) GROUP BY ALL),
leaf AS (SELECT r.doc_id, r.h, n_bytes, min(d) AS depth FROM r JOIN sums ON p = h >> (60 - d)::BIGINT
  WHERE b <= {SHARD_BYTES} OR c = 1 GROUP BY ALL)
SELECT doc_id, n_bytes, left(right(lpad(bin(h), 64, '0'), 60), depth::INT) AS shard, depth::INT AS depth, 0::BIGINT AS part FROM leaf""",
    "op3_substring_dedup": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s : s + 49], ' ') AS t FROM w, unnest(range(1, len(ws) - 48)) u(s)),
late AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY md5(t)) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, s + k AS i FROM late, range(0, 50) r(k)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT a.doc_id, count(g.i) AS out, string_agg(word, ' ' ORDER BY a.i) FILTER (WHERE g.i IS NULL) AS t
  FROM words a LEFT JOIN gone g ON a.doc_id = g.doc_id AND a.i = g.i GROUP BY a.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(out, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON w.doc_id = kept.doc_id""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    "op8_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(ws[s : s + 12], ' ') AS t, least(len(ws), 13) AS n
  FROM b, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) u(s) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, s, n, array_to_string(ws[s : s + n - 1], ' ') AS t FROM d, sizes, unnest(range(1, len(ws) - n + 2)) u(s)),
hits AS (SELECT doc_id, s, dw.n, item_id FROM dw JOIN bw ON dw.t = bw.t AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit ON d.doc_id = hit.doc_id LEFT JOIN items ON d.doc_id = items.doc_id""",
    "op9_chat_formatting": rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, replace(replace(replace(role, '\', '\\'), '<', '\<'), '>', '\>') AS er,
  replace(replace(replace(text, '\', '\\'), '<turn', '\<turn'), '</turn', '\</turn') AS et FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('<turn ' || er || '>' || et || '</turn>') + 1)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op10_ngram_jaccard": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '{_SPACE}') AS ws FROM documents),
g AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(ws[s : s + 2], ' ') AS t
  FROM w, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) u(s) WHERE len(ws) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 90 * (p.n + q.n - i)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id""",
    "op11_ranked_search": r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT DISTINCT i, item_id, term FROM (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
size AS MATERIALIZED (SELECT r, count(*) AS n FROM t GROUP BY r),
total AS MATERIALIZED (SELECT count(*) AS docs, sum(n)::BIGINT AS tokens FROM size),
tf AS MATERIALIZED (SELECT r, doc_id, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS MATERIALIZED (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, total GROUP BY term),
adds AS MATERIALIZED (SELECT tf.r, doc_id, tf.term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // tokens))) AS s
  FROM tf JOIN w ON w.term = tf.term JOIN size ON size.r = tf.r, total),
scores AS (SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(s)::BIGINT AS score FROM q JOIN adds ON adds.term = q.term GROUP BY i, r)
SELECT item_id, rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50""",
}

_ROUND = """
d{n} AS (SELECT v.vec_id, v.x, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.x[i] - c.c[i]) * (v.x[i] - c.c[i])))::BIGINT AS distance FROM v, c{n} c),
a{n} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, arg_min(cluster, distance * 1000 + cluster) AS cluster, min(distance) AS distance FROM d{n} GROUP BY vec_id)"""
_MOVE = """,
s{n} AS (SELECT cluster, i, sum(v)::BIGINT AS s, count(*) AS k FROM (SELECT cluster, unnest(x) AS v, unnest(range(1, 65)) AS i FROM a{n}) GROUP BY ALL),
c{m} AS MATERIALIZED (SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{n} c LEFT JOIN
  (SELECT cluster, list(CASE WHEN s < 0 AND s % k <> 0 THEN -((-s) // k) - 1 WHEN s < 0 THEN -((-s) // k) ELSE s // k END ORDER BY i) AS c FROM s{n} GROUP BY cluster) m
  ON m.cluster = c.cluster),"""

# Distinct vec_ids are taken for granted here.
ORACLE["op12_centroid_clustering"] = """
WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda y: floor(64 * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS cluster, x AS c FROM (SELECT sha256('1:' || vec_id) AS h, x FROM v ORDER BY h LIMIT 16)),""" + "".join(
    _ROUND.format(n=n) + (_MOVE.format(n=n, m=n + 1) if n < 3 else "") for n in range(4)) + """
SELECT vec_id, cluster::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia,
  (SELECT sha256(list_aggregate(list_transform(c.c, lambda y: y::VARCHAR), 'string_agg', ',')) FROM c3 c WHERE c.cluster = a3.cluster) AS centroid_sha256
FROM a3"""
