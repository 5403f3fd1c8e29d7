"""The registered text queries: each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import bpe, chat, minhash, mixing, pii, pseudo_likelihood, quality, sstable, topk, url_rules
from ridgeline.llm.common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score(table(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.assess(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sstable.encode_ordered(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, topk.every_hundredth(vectors))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_pseudo_likelihood": op2_pseudo_likelihood,
    "op3_url_rules": op3_url_rules,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_shards": op5_token_shards,
    "op6_chat_snapshots": op6_chat_snapshots,
    "op7_source_mix": op7_source_mix,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_private_data": op9_private_data,
    "op10_bpe_round_trip": op10_bpe_round_trip,
}
ORACLES = {
    "op1_near_duplicates": minhash.ORACLE,
    "op3_url_rules": url_rules.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op6_chat_snapshots": chat.ORACLE,
    "op7_source_mix": mixing.ORACLE,
    "op8_exact_top_k": topk.ORACLE,
    "op9_private_data": pii.ORACLE,
}
