"""Training corpus pipeline: five operators in a row over ``documents``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; each result is
written as Parquet to the shared folder and reread as the next stage's documents.  All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, encode, jaccard, repeats, toxicity
from strata.llm.common import release, written
from strata.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the multiple-instance model calls toxic go."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels", "doc_id", "toxic"))


def keep_one_near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, Jaccard 0.75) stays."""
    return jaccard.keep_one(docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier in the corpus are cut out of the texts."""
    return repeats.remove_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become piece ids: doc_id, ids, n_tokens, round_trip."""
    return encode.encode(docs, keep=["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_near_duplicate),
    ("suffix_array_dedup", remove_repeats),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece_encoding", encode_pieces),
]

# The stages learn models, follow links and sort suffixes: not SQL.  tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
