"""The queries of this subpackage: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.llm import bpe, chat_format, embedding_dedup, language_id, packing, quality, secret_scan, sharding, simhash, substring_dedup
from xmarket.llm.words import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.ranges(table(spark, sf_dir, "documents")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = language_id.held_out()
    model = language_id.fit(docs.where(~fold & F.col("doc_id").isNotNull()))
    return language_id.predict(docs, model).select("doc_id", fold.alias("held_out"), "lang_pred", "score")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.digest(chat_format.format_conversations(rows.unionByName(extra)))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, forest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (op1_substring_dedup, op2_bpe, op3_simhash, op4_language_id, op5_embedding_dedup, op6_chat_format, op7_sharding, op8_secret_scan, op9_packing, op10_quality_rules)
    return {f.__name__: f for f in named}


_ESCAPED = "regexp_replace(regexp_replace({0}, '\\\\', '\\\\\\\\', 'g'), '(<)(/?s>)|(\\[)(/?INST\\])', '\\1\\3\\\\\\2\\4', 'g')"

OP6_SQL = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (SELECT *, length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + 20 AS formatted FROM given)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


OP1_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w) x),
repeated AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
covered AS (SELECT DISTINCT doc_id, i + k AS place FROM windows JOIN repeated USING (s), range(0, 35) t(k)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept FROM words ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""


OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm FROM embeddings),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach AS (SELECT vec_id AS node, vec_id AS reached FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.reached),
parts AS (SELECT node, min(reached) AS component_id FROM reach GROUP BY node), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN parts ON node = vec_id LEFT JOIN counts ON a = vec_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op5_embedding_dedup": OP5_SQL, "op6_chat_format": OP6_SQL}
