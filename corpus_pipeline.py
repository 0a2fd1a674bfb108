"""A training corpus in five stages over the table documents.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes every stage's result as Parquet in
the folder that the cluster shares and reads it back as the next stage's documents.  All stages but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from xmarket.llm import language_id, near_copies, packing, secret_scan, substring_dedup
from xmarket.llm.words import table
from xmarket.session import discard, kept

#: Below this posterior a text has no language; clean prose is far above.
MIN_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: no letters, or no language with at least MIN_LANGUAGE_SCORE."""
    model = language_id.fit(docs.where(~language_id.held_out() & F.col("doc_id").isNotNull()))
    return language_id.keep_known(docs, model, MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies (shingles of five words)."""
    return near_copies.keep_first(docs, shingle=5)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 35 words and more that also start elsewhere; documents of which nothing is left go."""
    cut = substring_dedup.deduplicate(docs)
    return cut.where(F.col("text").isNull() | (F.trim(F.regexp_replace("text", "[\\x20\\x09-\\x0D]+", " ")) != ""))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts."""
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).drop("ids")


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("secret_scan", secrets),
    ("packing", packed),
]

#: Fingerprints, tokens and models can't be said in SQL; tests compare run() with brute force of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        docs = kept(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return docs
