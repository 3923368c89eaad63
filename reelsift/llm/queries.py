"""The registered queries of the operators, one per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reelsift.llm import (
    chat, conversation_repair, decontamination, fingerprints, html_text, mixing, near_duplicates, secrets, suffix_dedup, token_files, toxicity, vector_codes,
    vector_search,
)
from reelsift.llm.common import splitting_pattern, table, vocabulary
from reelsift.session import durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


@query("op1_decontamination")
def contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    held_out = toxicity.id_remainder(F.col("doc_id")) == 2
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query("op3_suffix_dedup")
def repeats_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@query("op4_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints.with_neighbours(fingerprints.edited_fingerprints(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.told(F.col("fingerprint")).alias("fingerprint"),
        fingerprints.told(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next", "n_within",
    )


@query("op5_mixed_sources")
def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


CONTROL = "<|im_end|><|im_start|>assistant ok"
_CHAT_SQL = rf"""WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{CONTROL}'), (-1, 1, 'assistant', '{CONTROL}')
), escaped AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body FROM given
), pieces AS (
  SELECT *, '<|im_start|>' || role || chr(10) || body || '<|im_end|>' || chr(10) AS piece FROM escaped
), counted AS (
  SELECT *, len(regexp_extract_all(piece, '{chat.TOKEN}')) AS tokens FROM pieces
), summed AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM counted
), placed AS (
  SELECT *, before // {chat.SPAN} AS slot, before = 0 AND role = 'system' AS is_system FROM summed
), slots AS (
  SELECT conv_id, slot, lead(min(before)) OVER (PARTITION BY conv_id ORDER BY slot) AS next_begin FROM placed GROUP BY conv_id, slot
), per_conversation AS (
  SELECT conv_id, count(*) AS n_windows FROM slots GROUP BY conv_id
), turns AS (
  SELECT p.*, n_windows, length(piece) * (1 + CASE WHEN is_system THEN n_windows - 1 WHEN next_begin - before <= {chat.HISTORY} THEN 1 ELSE 0 END) AS chars
  FROM placed p JOIN slots s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.slot = s.slot JOIN per_conversation c ON p.conv_id IS NOT DISTINCT FROM c.conv_id
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY before)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY before) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY before) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars, max(n_windows) AS n_windows
FROM turns GROUP BY conv_id"""


@query("op6_chat_windows", _CHAT_SQL)
def chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)], turns.schema)
    windows = durable(chat.format_conversations(turns.unionByName(own)))
    return chat.conversation_digests(windows)


@query("op7_html_text")
def html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@query("op8_token_files")
def token_files_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.with_crc(token_files.token_files(docs, vocabulary("byte_bpe_50k.json")))


@query("op9_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))


@query("op10_secrets")
def secrets_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secrets_per_document(docs, vocabulary("byte_bpe_50k.tiktoken"), splitting_pattern())


@query("op11_nearest_vectors")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.nearest_neighbours(table(spark, sf_dir, "embeddings"))


_REPAIR_SQL = r"""WITH RECURSIVE bits AS (
  SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM range(256) r(n)
), crc_table AS (
  SELECT list(t ORDER BY n) AS table_ FROM bits
), given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, table_[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS harm
  FROM given, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN harm = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE harm > 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS nth FROM damaged
), faults AS (
  SELECT conv_id, turn, role, text, nth, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY nth) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
    CASE substr(role, 1, 1) WHEN 's' THEN 's' WHEN 'u' THEN 'u' WHEN 'a' THEN 'a' ELSE '-' END AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY nth) AS before
  FROM placed
), told AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
    count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (nth > 1 AND before || substr(role, 1, 1) NOT IN ('su', 'ua', 'au')) AS illegal, max(nth) AS rows
  FROM faults GROUP BY conv_id
), letters(state, letter, need, next, price) AS (
  VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0), (0, 'R', '', 2, 2), (1, 'R', '', 2, 2),
    (3, 'R', '', 2, 2), (2, 'R', '', 3, 2), (0, 'D', '', 0, 3), (1, 'D', '', 1, 3), (2, 'D', '', 2, 3), (3, 'D', '', 3, 3)
), inserts(state, added, reached, paid) AS (
  VALUES (0, '', 0, 0), (1, '', 1, 0), (2, '', 2, 0), (3, '', 3, 0), (0, 'I', 2, 2), (1, 'I', 2, 2), (2, 'I', 3, 2), (3, 'I', 2, 2), (0, 'II', 3, 4), (1, 'II', 3, 4), (2, 'II', 2, 4), (3, 'II', 3, 4)
), ways AS (
  SELECT i.state, added || letter AS edit, added, reached, letter, need, next, paid + price AS cost FROM inserts i JOIN letters l ON l.state = i.reached
), walk AS (
  SELECT conv_id, rows, 0 AS nth, 0 AS state, {'cost': 0, 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS best FROM told
  UNION ALL
  SELECT w.conv_id, w.rows, w.nth + 1, y.next, min({'cost': w.best.cost + y.cost + CASE WHEN f.fault = 't' AND y.letter <> 'D' THEN 1 ELSE 0 END, 'audit': w.best.audit || y.edit,
    'lines': w.best.lines || CASE WHEN y.added = '' THEN CAST([] AS VARCHAR[]) WHEN y.added = 'I' THEN [CASE y.reached WHEN 2 THEN 'user:' ELSE 'assistant:' END]
      ELSE [CASE y.reached WHEN 3 THEN 'user:' ELSE 'assistant:' END, CASE y.reached WHEN 3 THEN 'assistant:' ELSE 'user:' END] END
      || CASE y.letter WHEN 'D' THEN CAST([] AS VARCHAR[]) WHEN 'K' THEN [f.role || ':' || f.text] ELSE [CASE y.next WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || f.text] END})
  FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.nth = w.nth + 1 JOIN ways y ON y.state = w.state
  WHERE (y.need = '' OR y.need = f.initial) AND (y.letter = 'D' OR f.fault NOT IN ('b', 'd'))
  GROUP BY w.conv_id, w.rows, w.nth, y.next
), closed AS (
  SELECT conv_id, min({'cost': best.cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END, 'audit': best.audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
    'lines': best.lines || CASE state WHEN 1 THEN ['user:', 'assistant:'] WHEN 2 THEN ['assistant:'] ELSE CAST([] AS VARCHAR[]) END}) AS best
  FROM walk WHERE nth = rows GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(best.cost, 0) AS BIGINT) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN told t ON c.conv_id IS NOT DISTINCT FROM t.conv_id LEFT JOIN closed d ON c.conv_id IS NOT DISTINCT FROM d.conv_id"""


@query("op12_repaired_conversations", _REPAIR_SQL)
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_repair.repair_report(conversation_repair.damaged(turns), turns)


def _codes_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd's rounds one after another, every distance component by component."""

    def nearest(k: int) -> str:
        return (
            f"a{k} AS MATERIALIZED (SELECT r, p, min(d * {vector_codes.ENTRIES} + e) AS best FROM"
            f" (SELECT r, p, e, sum((c.x - b.x) * (c.x - b.x)) AS d FROM components c JOIN b{k} b USING (p, j) GROUP BY r, p, e) GROUP BY r, p)"
        )

    def updated(k: int) -> str:
        return (
            f"b{k + 1} AS MATERIALIZED (SELECT p, e, j, coalesce(m, x) AS x FROM b{k} LEFT JOIN (SELECT p, CAST(best % {vector_codes.ENTRIES} AS BIGINT) AS e, j,"
            f" CAST(floor(sum(x)::DOUBLE / count(*)) AS BIGINT) AS m FROM components JOIN a{k} USING (r, p) GROUP BY ALL) USING (p, e, j))"
        )

    steps = ", ".join(f"{nearest(k)}, {updated(k)}" for k in range(rounds))
    return f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS r, list_transform(embedding, lambda x: CAST(floor(x::DOUBLE * {vector_codes.SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), listed AS (
  SELECT r, len(v) // {vector_codes.PARTS} AS w, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS k FROM kept
), components AS MATERIALIZED (
  SELECT r, k // w AS p, k % w AS j, x FROM listed
), b0 AS MATERIALIZED (
  SELECT p, r - 1 AS e, j, x FROM components WHERE r <= {vector_codes.ENTRIES}
), {steps}, {nearest(rounds)}, codes AS (
  SELECT r, string_agg(format('{{:02x}}', CAST(best % {vector_codes.ENTRIES} AS BIGINT)), '' ORDER BY p) AS code,
    CAST(sum(best // {vector_codes.ENTRIES}) AS BIGINT) AS error FROM a{rounds} GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
FROM kept JOIN codes USING (r)"""


@query("op13_vector_codes", _codes_sql())
def vector_codes_of_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes_with_label_errors(table(spark, sf_dir, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
