"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, langid, mixing, passages, pivot_search, prefix_hash, simhash, surrogates, toxicity, wrappers
from .common import crc_fold, table

#: A document with at least this score counts as toxic.
TOXIC_SCORE = 0.3


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = crc_fold("doc_id", 4)
    model = toxicity.train(docs, labels, fold != 2)
    scored = toxicity.score_documents(docs, model)
    held = F.coalesce(fold == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"), "spans")


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_pii(table(spark, sf_dir, "documents"), surrogates.key_of(spark))


def op6_prefix_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_hash.with_edits(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = crc_fold("doc_id", 3)
    found = langid.identify(docs, langid.train(docs, fold != 1))
    return found.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op9_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


QUERIES = {f.__name__: f for f in (op1_repeated_passages, op2_mix_sources, op3_simhash_groups, op4_toxicity, op5_surrogates, op6_prefix_fingerprints, op7_language, op8_main_text, op9_pivot_top_k, op10_bpe)}
ORACLES = {"op2_mix_sources": mixing.ORACLE_SQL, "op9_pivot_top_k": pivot_search.ORACLE_SQL}


def crc_of(value: int, modulus: int) -> int:
    """crc_fold outside Spark."""
    return zlib.crc32(str(value).encode()) % modulus
