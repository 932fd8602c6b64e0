"""Registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.llm import (
    hard_negatives,
    hash_ring,
    html_templates,
    merkle,
    mixing,
    multi_index,
    ngram_join,
    oracle,
    packing,
    quality_rules,
    suffix_repeats,
    token_prefix,
    url_lists,
    window_packing,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_soft_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Rates that bring the expected tokens to 80 % high, 15 % low, 5 % toxic."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return mixing.mixed(docs, labels, targets=[0.80, 0.15, 0.05]).drop("key")


def op2_multi_index_search(spark: SparkSession, folder: str) -> DataFrame:
    return multi_index.nearest(_table(spark, folder, "embeddings"), every=20, top=20)


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_groups(_table(spark, folder, "documents"), words=3, num=90, den=100)


def op4_template_removal(spark: SparkSession, folder: str) -> DataFrame:
    return html_templates.extracted(_table(spark, folder, "pages"))


def op5_bounded_ring(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen shards with row counts at most one apart."""
    return hash_ring.sharded(_table(spark, folder, "documents"), shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_temporal_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages")
    return url_lists.judged(url_lists.captures_of(pages), url_lists.dated_lists(pages))


def op7_prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_prefix.token_counts(_table(spark, folder, "documents"), vocabulary=vocabulary, limit=512)


def op8_best_two_fit(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.packed_documents(_table(spark, folder, "documents"), vocabulary=vocabulary, end_id=1, size=4096)


def op9_adaptive_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(_table(spark, folder, "documents"))


def op10_interval_expansion(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_repeats.removal_report(_table(spark, folder, "documents"), length=200)


def op11_best_fit_windows(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return window_packing.packing_report(_table(spark, folder, "documents"), vocabulary=vocabulary, end_id=1, size=2048)


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.audited(_table(spark, folder, "documents"))


def op13_angular_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(_table(spark, folder, "embeddings"), every=100)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = (
        op1_soft_mixing,
        op2_multi_index_search,
        op3_ngram_jaccard,
        op4_template_removal,
        op5_bounded_ring,
        op6_temporal_lists,
        op7_prefix_counts,
        op8_best_two_fit,
        op9_adaptive_quality,
        op10_interval_expansion,
        op11_best_fit_windows,
        op12_merkle_manifest,
        op13_angular_negatives,
    )
    return {f.__name__: f for f in listed}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL with the same result, for the queries that SQL can express."""
    return dict(oracle.ORACLES)
