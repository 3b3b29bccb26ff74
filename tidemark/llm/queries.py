"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    conversation_trie,
    decontamination,
    licenses,
    line_rules,
    quality_crf,
    sentencepiece_viterbi,
    sharding,
    simhash,
    token_alignment,
    token_counts,
    url_reputation,
    vector_graph,
    wavelet_output,
)
from tidemark.llm.common import table


def op1_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, folder, "documents")).drop("spans")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_counts.token_counts(table(spark, folder, "documents"), vocabulary)


def op3_wavelet_output(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet_output.token_output(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model_file = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, folder, "documents")
    return sentencepiece_viterbi.round_trip(docs, model_file, sentencepiece_viterbi.ranked_viterbi)


def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_reputation.judged_pages(table(spark, folder, "pages"))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_crf.document_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_passages(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_rules.judged_documents(table(spark, folder, "documents")).drop("clean_text")


def op10_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op11_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.numbered_turns(table(spark, folder, "conversations"))
    return conversation_trie.prefix_trie(*conversation_trie.rebuilt_conversations(turns))


def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return token_alignment.aligned_documents(table(spark, folder, "documents"), *files)


def op13_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vector_graph.nearest_neighbours(vectors, vectors.where("vec_id % 50 = 0"), k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": op1_license_scans,
    "op2_token_counts": op2_token_counts,
    "op3_wavelet_output": op3_wavelet_output,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_sharding": op5_sharding,
    "op6_url_filters": op6_url_filters,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_decontamination": op8_decontamination,
    "op9_quality_rules": op9_quality_rules,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_conversation_prefix_trie": op11_conversation_prefix_trie,
    "op12_cross_tokenizer_alignment": op12_cross_tokenizer_alignment,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}
