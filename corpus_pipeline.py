"""Training-data pipeline: rejects bad documents, deduplicates three ways and packs the rest into sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is written as Parquet and
read again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowlens.llm import dart_minhash, exact_dedup, packing, quality_rules, run_length_index
from flowlens.llm.common import table
from flowlens.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list accept."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class, the one with the smallest id."""
    return dart_minhash.keep_one(docs)


#: Least length of a passage that goes: 51 words of short ones take about 280 bytes.
PASSAGE_BYTES = 250


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of PASSAGE_BYTES or more that start more than once in the corpus."""
    return run_length_index.strip_repeats(docs, PASSAGE_BYTES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("repeated passages", repeats), ("packing", pack)]

#: Hashing, indexes and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
