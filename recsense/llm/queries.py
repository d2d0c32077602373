"""Registered queries of the corpus operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_dedup import repeated_bytes
from .common import documents
from .exact_dedup import exact_dedup
from .language import identify
from .licenses import BLOCK as LICENSE_BLOCK
from .licenses import PHRASES, STEP, TEMPLATES, THRESHOLD, license_scan
from .mixing import mix
from .packing import pack
from .phrase_dedup import repeated_phrases
from .prefix_trie import NO_TEXT, prefix_trie
from .repair import BLOCK, FAN, damaged, repair, transcripts
from .simhash import near_duplicates
from .tokens import token_counts
from .topk import top_k
from .toxicity import fit_toxicity, score_toxicity


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def removed(spans: str) -> Column:
    """Units in the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", removed("spans").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")

def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score_toxicity(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_phrases(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", removed("spans").alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def repaired(conversations: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Every conversation of ``conversations``, with the report and the transcript's digest of its damaged rows."""
    report, turns = repair(damaged(conversations), block, fan)
    found = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for part in (report, transcripts(turns)):
        found = found.join(part.withColumnRenamed("conv_id", "of_conv"), F.col("conv_id").eqNullSafe(F.col("of_conv")), "left").drop("of_conv")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(NO_TEXT)).alias("repaired_sha256"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP2_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
), weighed AS (
  SELECT *, CAST(source_size AS DOUBLE) * 2.0e0 AS most,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0e0 WHEN 1 THEN 1.0e0 ELSE 2.0e0 END AS weight
  FROM per
), levels AS (
  SELECT *, (sum(CAST(source_size AS DOUBLE)) OVER () * 1.5e0
      - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0e0)) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM levels
), rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0e0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0e0 AS draw
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  size * CAST(floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM rated
"""

OP7_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content FROM documents
), g AS (
  SELECT doc_id, content, count(*) OVER (PARTITION BY content) AS group_size,
    first_value(doc_id) OVER (PARTITION BY content ORDER BY n DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM g
"""


def crc32_sql(text: str) -> str:
    """The crc32 of ASCII text in SQL, bit by bit."""
    byte = "lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]"
    bits = f"list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split({text}, ''), {byte})))"
    return f"xor(list_reduce({bits}, lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) % 2 = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)), 4294967295)"


OP11_SQL = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 9 AS h, list({{'role': role, 'text': text}} ORDER BY k) AS turns FROM own GROUP BY conv_id
), r AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS path FROM c a LEFT JOIN c b ON b.conv_id = a.base
), p AS (
  SELECT conv_id, d, path[1:d] AS path, d = len(path) AS ended FROM (SELECT conv_id, path, unnest(generate_series(0, len(path))) AS d FROM r)
), n AS (
  SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CASE WHEN ended THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM p GROUP BY path, d
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1
), own_values AS (
  SELECT n.path, n.depth, CASE WHEN k.path IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * coalesce(strlen(n.path[n.depth].text), 0) AS saved FROM n LEFT JOIN kids k ON k.path = n.path
), totals AS (
  SELECT path[1:d] AS path, sum(leaf) AS n_leaves, sum(saved) AS saved FROM (SELECT *, unnest(generate_series(0, depth)) AS d FROM own_values) GROUP BY 1
)
SELECT n.conv_id, n.depth, CASE WHEN n.depth > 0 THEN up.conv_id END AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
  CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN totals t ON t.path = n.path LEFT JOIN kids k ON k.path = n.path LEFT JOIN n up ON n.depth > 0 AND up.path = n.path[1:n.depth - 1]
"""

OP12_SQL = rf"""
WITH RECURSIVE inserts(q, q2, price, edits, said) AS (VALUES
  (0, 0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])
), legal(q, initial, q2) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
acts AS (
  SELECT q, initial, q2, 'K' AS edit, 0 AS price FROM legal
  UNION ALL SELECT q, initial, q2, 'R', 1 FROM legal WHERE initial <> 's'
  UNION ALL SELECT q, NULL, q, 'D', 2 FROM (VALUES (0), (1), (2), (3)) s(q)
), filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations
), kinds AS (
  SELECT *, {crc32_sql("key")} % 20 AS kind FROM filled
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM kinds WHERE kind <> 0
), placed AS (
  SELECT *, coalesce(conv_id, -1) AS c, conv_id IS NULL AS void, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest FROM damaged
), faulty AS (
  SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
    WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    CASE WHEN lag(role) OVER w IS NOT NULL AND left(lag(role) OVER w, 1) || left(role, 1) NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END AS illegal
  FROM placed WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), ways(c, void, k, q, best) AS (
  SELECT DISTINCT c, void, CAST(0 AS BIGINT), 0, {{'cost': 0, 'audit': '', 'said': CAST([] AS VARCHAR[])}} FROM faulty
  UNION ALL
  SELECT w.c, w.void, w.k + 1, a.q2, min({{
      'cost': w.best.cost + i.price + a.price + CASE WHEN f.fault = 'truncated' AND a.edit <> 'D' THEN 5 ELSE 0 END,
      'audit': w.best.audit || i.edits || a.edit,
      'said': list_concat(w.best.said, i.said, CASE a.edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [CASE a.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text] END)}})
  FROM ways w JOIN faulty f ON f.c = w.c AND f.void = w.void AND f.k = w.k + 1 JOIN inserts i ON i.q = w.q JOIN acts a ON a.q = i.q2
  WHERE a.edit = 'D' OR (coalesce(f.fault, 'truncated') = 'truncated' AND (a.edit = 'R' OR a.initial = left(f.role, 1)))
  GROUP BY w.c, w.void, w.k + 1, a.q2
), ended AS (
  SELECT w.c, w.void, min({{'cost': w.best.cost + i.price, 'audit': w.best.audit || i.edits, 'said': list_concat(w.best.said, i.said)}}) AS best
  FROM ways w JOIN (SELECT c, void, max(k) AS k FROM faulty GROUP BY c, void) l ON l.c = w.c AND l.void = w.void AND l.k = w.k JOIN inserts i ON i.q = w.q AND (i.q2 = 3 OR i.q2 = 0)
  GROUP BY w.c, w.void
), counts AS (
  SELECT c, void, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, sum(illegal) AS illegal
  FROM faulty GROUP BY c, void
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal,
  CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts n ON n.c = coalesce(o.conv_id, -1) AND n.void = (o.conv_id IS NULL) LEFT JOIN ended e ON e.c = n.c AND e.void = n.void
"""

OP13_SQL = rf"""
WITH phrases(phrase, label) AS (VALUES {", ".join(f"(string_split('{p}', ' '), '{c}')" for p, c in PHRASES.items())}),
templates(label, words) AS (VALUES {", ".join(f"('{c}', list_distinct(string_split('{t}', ' ')))" for c, t in TEMPLATES)}),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS k FROM d
), places AS (
  SELECT d.r, w.k, p.label FROM w JOIN phrases p ON w.word = p.phrase[1] JOIN d USING (r) WHERE d.words[w.k + 1 : w.k + len(p.phrase)] = p.phrase
), base AS (
  SELECT r, count(*) AS n_base, min(k) AS first_word, max(k) AS last_word, list(DISTINCT label) AS named FROM places GROUP BY r
), blocks AS (
  SELECT r, words[k + 1 : k + {LICENSE_BLOCK}] AS block FROM (SELECT r, words, unnest(generate_series(0, greatest(len(words) - 1 - {LICENSE_BLOCK - STEP}, 0), {STEP})) AS k FROM d)
), shares AS (
  SELECT b.r, t.label, len(list_intersect(t.words, b.block)) AS shared, len(t.words) AS size FROM blocks b, templates t
), joined AS (
  SELECT r, list(DISTINCT label) AS joined, max(CAST(shared AS DOUBLE) / size) AS best FROM shares WHERE shared >= ceil({THRESHOLD}e0 * size - 1e-9) GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  array_to_string(list_sort(coalesce(named, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(named, []), coalesce(joined, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0e0 ELSE coalesce(best, 0.0e0) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN joined USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_mix": op2_mix,
    "op3_pack": op3_pack,
    "op4_simhash": op4_simhash,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_repair": op12_repair,
    "op13_license_scan": op13_license_scan,
}

ORACLE_SQL: dict[str, str] = {
    "op1_top_k": OP1_SQL,
    "op2_mix": OP2_SQL,
    "op7_exact_dedup": OP7_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_repair": OP12_SQL,
    "op13_license_scan": OP13_SQL,
}
