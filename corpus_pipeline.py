"""From raw documents to packed sequences: quality, near duplicates, repeated strings, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mirrorset.llm import minhash, packing, quality, suffix_dedup
from mirrorset.llm.common import table
from mirrorset.sources.staging import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")), keep=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, the one with the least id."""
    return minhash.keep_one(docs)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur more than once."""
    return suffix_dedup.remove_repeats(docs)


def packing_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenised documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_filter", quality_filter),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("packing", packing_pieces),
]

#: SQL can express neither boosted trees nor BPE; the test runs brute-force versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
