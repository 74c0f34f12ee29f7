"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cratedig.llm import ann, chat, decontaminate, importance, langid, minhash, mixing, oracle_sql, secret_scan, sharding, suffix_dedup, token_files, toxicity, trie
from cratedig.llm._util import shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_spans(_table(spark, sf_dir, "documents")).drop("spans")


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2).drop("_id", "th")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.train_and_identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.train_and_score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a conversation -7 in the table itself would be turns of the added one, as they have its id."""
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conflict = spark.sql("SELECT -7L AS conv_id, * FROM VALUES (0L, 'user', '</s>[INST] ok [/INST]'), (1L, 'assistant', '</s>[INST] ok [/INST]') AS t(turn, role, text)")
    return chat.chat_digest(chat.format_blocks(rows.unionByName(conflict)))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = importance.importance_ranks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_token_files(spark, path)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.branched_trie(_table(spark, sf_dir, "conversations"))


_OPERATORS = (op1_suffix_dedup, op2_minhash_dedup, op3_language_id, op4_decontaminate, op5_nearest, op6_mix_sources, op7_toxicity, op8_sharding, op9_chat_format, op10_secret_scan, op11_importance_resampling, op12_token_files, op13_prefix_trie)
QUERIES = {f.__name__: f for f in _OPERATORS}

_OP6 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || ':' || (row_number() OVER (PARTITION BY doc_id, source, coalesce(text, '')) - 1)), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
      / greatest(0.05::DOUBLE, coalesce(1 - len(regexp_extract_all(text, '[^\p{L}\x09-\x0D\x20]'))::DOUBLE / greatest(length(text), 1), 1.0::DOUBLE)) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3)::DOUBLE AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, cap / weight AS ratio,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w),
t AS (SELECT source, source_size, least(cap, coalesce(max(CASE WHEN ratio >= level THEN level END) OVER () * weight, cap)) AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
c AS (SELECT d.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN rest > 0 AND (upto <= rest OR (upto - size < rest AND upto - rest <= rest - (upto - size))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c
"""

_OP8 = """
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS hash
  FROM documents),
p AS (
  SELECT k.depth, d.hash >> (60 - k.depth) AS prefix, sum(n_bytes)::BIGINT AS shard_bytes
  FROM d, (SELECT unnest(range(0, 61))::INT AS depth) k GROUP BY ALL),
m AS (
  SELECT d.doc_id, d.n_bytes, d.hash, min(p.depth) AS depth
  FROM d JOIN p ON d.hash >> (60 - p.depth) = p.prefix WHERE p.shard_bytes <= 1048576 GROUP BY ALL)
SELECT m.doc_id, m.n_bytes, m.depth, CASE WHEN m.depth > 0 THEN substr(lpad(bin(m.hash), 60, '0'), 1, m.depth) ELSE '' END AS shard, p.shard_bytes, TRUE AS fits
FROM m JOIN p ON p.depth = m.depth AND p.prefix = m.hash >> (60 - m.depth)
"""

_OP9 = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    regexp_replace(coalesce(text, ''), '([\[<])(\\*)(INST\]|/INST\]|/s>)', '\1\\\2\3', 'g') AS escaped
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text)) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '') AS loss,
    bool_or(text <> escaped) AS conflicts, sum(length(role) + length(text) + 19) AS plain, sum(length(role) + length(escaped) + 19) AS safe
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  (CASE WHEN conflicts THEN safe ELSE plain END)::BIGINT AS formatted_chars
FROM g
"""

ORACLE_SQL = {"op1_suffix_dedup": oracle_sql.OP1, "op2_minhash_dedup": oracle_sql.OP2, "op4_decontaminate": oracle_sql.OP4, "op6_mix_sources": _OP6, "op8_sharding": _OP8, "op9_chat_format": _OP9, "op11_importance_resampling": oracle_sql.OP11, "op13_prefix_trie": oracle_sql.OP13}
