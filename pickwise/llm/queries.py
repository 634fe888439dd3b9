"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pickwise.llm import cotrain, decontaminate, hard_negatives, langid, line_dedup, mixing, near_dups, secret_scan, token_rollup, tool_calls, toxicity, turn_repair, version_sketch
from pickwise.llm.common import table
from pickwise.session import shared_dir


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.learn(docs))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cotrain.score(docs, cotrain.learn(docs, table(spark, sf_dir, "labels")))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.learn(docs))


def op8_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.corpus_history(spark, table(spark, sf_dir, "documents"), shared_dir(spark, "token-ledger")).rollup()


def op9_version_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_sketch.fingerprints(table(spark, sf_dir, "documents"))


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tool_calls.link(*tool_calls.from_conversations(table(spark, sf_dir, "conversations")), tool_calls.SCHEMAS)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return turn_repair.digest_report(turn_repair.repair(turn_repair.damage(turns), turns))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(line_dedup.drop_common_lines(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_secret_scan": op2_secret_scan,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_source_mixing": op5_source_mixing,
    "op6_simhash_near_dups": op6_simhash_near_dups,
    "op7_language_id": op7_language_id,
    "op8_token_rollup": op8_token_rollup,
    "op9_version_fingerprints": op9_version_fingerprints,
    "op10_tool_calls": op10_tool_calls,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
}
# A system or user turn is a call, an assistant turn the result of the turn before it.
OP10_SQL = """
WITH t AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, text FROM conversations),
r AS (
  SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text FROM t WHERE role = 'assistant'
),
c AS (
  SELECT conv_id, turn, conv_id || ':' || turn AS call_id,
         CASE WHEN role = 'system' THEN 'configure' ELSE 'reply' END AS name,
         CASE WHEN role = 'system' THEN '{"instructions":' || CAST(to_json(text) AS VARCHAR) || '}'
              ELSE '{"prompt":' || CAST(to_json(text) AS VARCHAR) || ',"turn":' || turn || '}' END AS arguments,
         CASE WHEN turn >= 2 THEN '["' || conv_id || ':' || (turn - 2) || '","' || conv_id || ':' || (turn - 1) || '"]'
              WHEN turn = 1 THEN '["' || conv_id || ':0"]' ELSE '[]' END AS depends_on,
         text
  FROM t WHERE role IN ('system', 'user')
)
SELECT c.conv_id, c.turn AS order_key, c.turn, c.call_id, c.name,
       CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
       length(c.text) > 0 AS valid,
       CASE WHEN length(c.text) > 0 THEN '' WHEN c.name = 'reply' THEN '$.prompt: shorter than 1' ELSE '$.instructions: shorter than 1' END AS errors,
       '{"arguments":' || c.arguments || ',"depends_on":' || c.depends_on || ',"id":"' || c.call_id || '","name":"' || c.name
         || '","result":' || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null')
         || ',"status":"' || CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END || '"}' AS message
FROM c LEFT JOIN r ON c.call_id = r.call_id
UNION ALL
SELECT r.conv_id, r.turn AS order_key, r.turn, r.call_id, CAST(NULL AS VARCHAR) AS name, 'orphan' AS status, true AS valid, '' AS errors,
       '{"arguments":null,"depends_on":[],"id":"' || r.call_id || '","name":null,"result":' || CAST(to_json(r.text) AS VARCHAR) || ',"status":"orphan"}' AS message
FROM r WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.call_id = r.call_id)
"""

# CRC-32 by its table; then a dynamic program over rows and the states 0 (start), 1 (after s),
# 2 (after u), 3 (after a), at most one insert before each row and at the end.
OP11_SQL = """
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([CAST(i AS BIGINT)] || range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) AS r(i))
), given AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), marked AS (
  SELECT given.*, xor(list_reduce([4294967295] || list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT)),
                      lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 20 AS fault
  FROM given, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE fault <> 0
), placed AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, substr(role, 1, 1) AS c,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen
  FROM damaged
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed
), counts AS (
  SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE i > 1 AND before || c NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faulty GROUP BY conv_id
), edit(letter, price) AS (VALUES ('K', 0), ('R', 1), ('D', 2)
), state(q, made, q2) AS (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), way AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS body FROM counts
  UNION ALL
  SELECT conv_id, i, q, cost, audit, body FROM (
    SELECT conv_id, i, q, cost, audit, body, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS place FROM (
      SELECT w.conv_id, w.i + 1 AS i,
             CASE WHEN letter = 'D' THEN w.q WHEN letter = 'R' THEN s.q2 WHEN f.c = 's' THEN 1 WHEN f.c = 'u' THEN 2 ELSE 3 END AS q,
             w.cost + price + CASE WHEN letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost,
             w.audit || letter AS audit,
             w.body || CASE WHEN letter = 'D' THEN '' WHEN w.body = '' THEN '' ELSE chr(10) END
                    || CASE WHEN letter = 'D' THEN '' WHEN letter = 'K' THEN f.role || ':' || f.text
                            WHEN s.made = 'u' THEN 'user:' || f.text ELSE 'assistant:' || f.text END AS body
      FROM (
        SELECT conv_id, i, q, cost, audit, body FROM way
        UNION ALL
        SELECT conv_id, i, q2, cost + 5, audit || 'I', body || CASE WHEN body = '' THEN '' ELSE chr(10) END || CASE WHEN made = 'u' THEN 'user:' ELSE 'assistant:' END
        FROM way JOIN state USING (q)
      ) w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
      JOIN state s ON s.q = w.q
      CROSS JOIN edit
      WHERE letter = 'D' OR (f.fault NOT IN ('blank', 'duplicate') AND (letter = 'R' OR (f.c = 's' AND w.q = 0) OR f.c = s.made))
    )
  ) WHERE place = 1
), ended AS (
  SELECT w.conv_id, w.q, w.cost, w.audit, w.body FROM way w JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i
), finished AS (
  SELECT conv_id, cost, audit, body, row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) AS place FROM (
    SELECT conv_id, cost, audit, body FROM ended WHERE q IN (0, 3)
    UNION ALL
    SELECT conv_id, cost + 5, audit || 'I', body || chr(10) || 'assistant:' FROM ended WHERE q = 2
  )
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(f.cost, 0) AS cost, coalesce(f.audit, '') AS audit, sha256(coalesce(f.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM given) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN finished f ON f.conv_id IS NOT DISTINCT FROM o.conv_id AND f.place = 1
"""

OP12_SQL = """
WITH given AS (
  SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), score AS (
  SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS s
  FROM given a, given r WHERE a.id % 100 = 0 AND a.id <> r.id
), positive AS (
  SELECT anchor_id, id AS positive_id, s AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) AS place FROM score WHERE same) WHERE place <= 5
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, id AS negative_id, positive_score, s AS negative_score FROM (
  SELECT p.*, n.id, n.s, row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.s DESC, n.id) AS place
  FROM positive p JOIN score n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.positive_score <= 100 * n.s AND n.s <= p.positive_score
) WHERE place <= 5
"""

OP13_SQL = """
WITH given AS (
  SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT r, doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM given
), keyed AS (
  SELECT r, coalesce(CAST(doc_id AS VARCHAR), ':' || text) AS doc, doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common c ON c.key = keyed.key GROUP BY r, doc_id
"""

ORACLE_SQL: dict[str, str] = {"op10_tool_calls": OP10_SQL, "op11_conversation_repair": OP11_SQL, "op12_hard_negatives": OP12_SQL, "op13_line_dedup": OP13_SQL}
