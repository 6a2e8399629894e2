"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from topicpulse.llm import (
    bpe,
    conversation_trie,
    decontaminate,
    html_text,
    kd_sharding,
    kneser_ney,
    line_dedup,
    near_duplicates,
    oracle,
    quality_model,
    quality_rules,
    secrets,
    sharded_lloyd,
    token_counts,
)
from topicpulse.llm.common import read


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(
        read(spark, folder, "documents"), read(spark, folder, "benchmark")
    )
    return leaks.select("doc_id", "item_id", "n_found", "n_windows")


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read(spark, folder, "pages"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.dedup_lines(read(spark, folder, "documents")).select(
        "doc_id", "text", "n_lines", "n_removed"
    )


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.apply_rules(
        read(spark, folder, "documents"), read(spark, folder, "labels")
    )
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    reasons = F.array_join("rejected_by", ",").alias("rejected_by")
    return judged.select("doc_id", *counts, "base_failed", "kept", reasons)


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.components(read(spark, folder, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


def op6_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(read(spark, folder, "documents"))


def op7_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    return kd_sharding.shard(read(spark, folder, "documents"))


def op8_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.score(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, folder, "documents"))


def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_counts(read(spark, folder, "documents"))


def op11_sharded_lloyd(spark: SparkSession, folder: str) -> DataFrame:
    return sharded_lloyd.cluster(read(spark, folder, "embeddings"))


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, folder, "conversations"))


def op13_kneser_ney(spark: SparkSession, folder: str) -> DataFrame:
    return kneser_ney.score_corpus(read(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_html_extraction,
        op3_line_dedup,
        op4_quality_rules,
        op5_near_duplicates,
        op6_bpe_round_trip,
        op7_kd_shards,
        op8_quality_scores,
        op9_token_counts,
        op10_secrets,
        op11_sharded_lloyd,
        op12_conversation_trie,
        op13_kneser_ney,
    )
}

ORACLE: dict[str, str] = dict(oracle.ORACLE)
