"""The operators over their whole tables: queries and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.alignment import TokenizerPair, alignment_report
from tidemark.llm.bpe import Vocabulary, bpe_report
from tidemark.llm.chat import chat_report
from tidemark.llm.embeddings import linked_vectors
from tidemark.llm.licenses import license_report
from tidemark.llm.licenses import oracle as license_sql
from tidemark.llm.lm_score import lm_scores
from tidemark.llm.merkle import fingerprint_report
from tidemark.llm.minhash import near_duplicates
from tidemark.llm.mixing import WEIGHTS, in_mixed_order, own_weights
from tidemark.llm.repair import repair_report
from tidemark.llm.sharding import shard_report
from tidemark.llm.shared import ship
from tidemark.llm.substring_dedup import remove_repeats
from tidemark.llm.toxicity import fit_toxicity, toxicity_scores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"), cosine=0.9)


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(table(spark, sf_dir, "documents"), shards=16)


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = Vocabulary.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe_report(table(spark, sf_dir, "documents"), vocabulary)


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the order of a mix of a stream for each source, with their places."""
    docs = table(spark, sf_dir, "documents")
    return in_mixed_order(docs, own_weights(docs, WEIGHTS), places=True)


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    turns = table(spark, sf_dir, "conversations")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_report(turns.select(*more.columns).unionByName(more))


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=85)


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = TokenizerPair.load(*map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model")))
    return alignment_report(table(spark, sf_dir, "documents"), pair)


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"))


QUERIES["pipeline"] = corpus_pipeline.run


ORACLES["op8_substring_dedup"] = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS n FROM windows)
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i + o AS i FROM later, range(20) t(o)
), dropped AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(x.gone), 0)::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(
         CASE WHEN x.gone IS NULL THEN w
              ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(x.gone, i)), lambda i: w[i]) END, ' '), '')) AS kept_sha256
FROM words d LEFT JOIN dropped x USING (doc_id)
"""

ORACLES["op7_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, regexp_replace(text, '(<|\[)(\\*)(s>|/s>|<SYS>>|</SYS>>|<ANS>>|</ANS>>|INST\]|/INST\]|ROLE\]|/ROLE\])', '\1\\\2\3', 'g') AS body
  FROM turns
), placed AS (
  SELECT *, row_number() OVER w AS place,
    lag(role, 1, '<start>') OVER w AS previous, lead(role) OVER w IS NULL AS ends,
    CASE role WHEN 'user' THEN '<s>[INST] ' || body || ' [/INST]</s>'
      WHEN 'assistant' THEN '<s><<ANS>> ' || body || ' <</ANS>></s>'
      WHEN 'system' THEN '<s><<SYS>> ' || body || ' <</SYS>></s>' END AS said
  FROM marked WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), judged AS (
  SELECT *, (previous, role) IN (('<start>','system'), ('<start>','user'), ('system','user'), ('user','assistant'),
    ('assistant','user'), ('assistant','tool'), ('tool','assistant')) AS fits
  FROM placed
), chats AS (
  SELECT conv_id, count(*) AS n,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
    sum(length(said)) AS chars,
    coalesce(min(place - 1) FILTER (NOT fits), CASE WHEN bool_or(ends AND role <> 'assistant') THEN count(*) END) AS refused
  FROM judged GROUP BY conv_id
)
SELECT conv_id, n::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars, refused IS NULL AS accepted, refused::BIGINT AS refused_at
FROM chats
"""

ORACLES["op1_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM vectors a JOIN vectors b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vectors UNION SELECT v, other FROM reached JOIN links ON u = vec_id
), least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT vec_id, count(u) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN links ON u = vec_id GROUP BY vec_id, component_id
"""

ORACLES["op9_minhash_near_dedup"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT u, v FROM common c JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v WHERE 100 * c.n >= 85 * (a.n + b.n - c.n)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT v, other FROM reached JOIN links ON u = doc_id
), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""

ORACLES["op12_license_scan"] = license_sql()

ORACLES["op13_conversation_repair"] = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
      [4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::BIGINT),
      lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS n_th,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending
  FROM damaged
), judged AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS initial,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN ending = '' THEN 'blank' WHEN n_th > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault
  FROM placed
), sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), inserts AS (  -- states: 0 nothing said, 1 system, 2 user, 3 assistant
  SELECT * FROM (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 2, 'I', 'u'), (1, 2, 2, 'I', 'u'), (3, 2, 2, 'I', 'u'), (2, 3, 2, 'I', 'a'), (0, 3, 4, 'II', 'ua'), (1, 3, 4, 'II', 'ua'))
    t(old, mid, price, ops, said)
), edits AS (
  SELECT * FROM (VALUES (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
    (0, 'R', 'u', 2), (1, 'R', 'u', 2), (2, 'R', 'a', 3), (3, 'R', 'u', 2), (0, 'D', '', 0), (1, 'D', '', 1), (2, 'D', '', 2), (3, 'D', '', 3))
    t(mid, op, becomes, new)
), names AS (SELECT * FROM (VALUES ('u', 'user'), ('a', 'assistant')) t(letter, name)
), step(conv_id, i, state, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'audit': ''} FROM sums
  UNION ALL
  SELECT s.conv_id, s.i + 1, e.new, min({
      'cost': s.best.cost + n.price + CASE e.op WHEN 'K' THEN 0 WHEN 'R' THEN 2 ELSE 3 END + CASE WHEN e.op <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END,
      'audit': s.best.audit || n.ops || e.op})
  FROM step s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.i = s.i + 1
  JOIN inserts n ON n.old = s.state JOIN edits e ON e.mid = n.mid
  WHERE e.op = 'D' OR (j.fault NOT IN ('blank', 'duplicate') AND (e.op = 'R' OR e.becomes = j.initial))
  GROUP BY s.conv_id, s.i + 1, e.new
), ended AS (
  SELECT s.conv_id, min({'cost': best.cost + n.price, 'audit': best.audit || n.ops}) AS best
  FROM step s JOIN sums t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.n = s.i
  JOIN inserts n ON n.old = s.state WHERE n.mid IN (0, 3) GROUP BY s.conv_id
), letters AS (
  SELECT conv_id, best.audit AS audit, unnest(range(1, length(best.audit) + 1)) AS k FROM ended
), used AS (
  SELECT conv_id, k, audit[k] AS op, count(*) FILTER (audit[k] <> 'I') OVER w AS i,
    count(*) FILTER (audit[k] <> 'D') OVER w AS said
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY k)
), kept AS (  -- the role follows from the place: a system turn moves it by one
  SELECT u.*, j.role, j.text, max(CASE WHEN op = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY u.conv_id) AS system
  FROM used u LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM u.conv_id AND j.i = u.i
  WHERE op <> 'D'
), texts AS (
  SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role ELSE CASE WHEN (said - system) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS said
  FROM kept GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
  coalesce(e.best.audit, '') AS audit, sha256(coalesce(x.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""
