"""One registered query per operator, with production parameters, over whole tables.

``QUERIES`` maps the names to ``(spark, sf_dir) -> DataFrame``; ``ORACLES`` has the
SQL of those that SQL can express.  The others are tested against brute force in
``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import read_table
from . import chat, ctw, decontaminate, encode, fingerprint, hamming, jaccard, langid, oracles, repeats, sharding, spelling, toxicity, whitening

SHARDS = 40


def op1_hmm_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_report(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op2_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(read_table(spark, sf_dir, "documents", "doc_id", "text"), SHARDS)


def op3_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.scoring_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_suffix_array_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(read_table(spark, sf_dir, "documents", "doc_id", "text"), keep=["doc_id"])


def op5_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                              read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def op6_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                                    read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op8_jaccard_multi_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_suffix_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_segmentation_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(read_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op11_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_bk_tree_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_bloom_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(read_table(spark, sf_dir, "documents", "doc_id", "text"))


QUERIES = {f.__name__: f for f in (
    op1_hmm_chat, op2_jump_sharding, op3_context_tree, op4_suffix_array_encoding, op5_positional_index,
    op6_chunk_fingerprints, op7_toxicity, op8_jaccard_multi_order, op9_suffix_radix_dedup, op10_segmentation_langid,
    op11_refined_whitening, op12_bk_tree_simhash, op13_bloom_spelling)}

# The others cannot be written as one SQL statement with equal results: their hashes, models
# and iterations are not SQL.  tests/llm holds brute-force versions.
ORACLES: dict[str, str] = {
    "op5_positional_index": oracles.CONTAMINATION,
    "op8_jaccard_multi_order": oracles.NEAR_DUPLICATES,
    "op9_suffix_radix_dedup": oracles.REPEATS,
}
