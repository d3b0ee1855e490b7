"""From raw documents to packed training sequences, stage by stage.

Each stage takes the documents its predecessor kept and returns the columns of
``documents``; the last one returns packed pieces. SQL can't express the
learned and hashed stages, so the result is tested against plain versions.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockyard.llm.exact_dedup import drop_exact
from dockyard.llm.langid import drop_rejected
from dockyard.llm.minhash import drop_near
from dockyard.llm.packing import pack_documents
from dockyard.llm.repeats import drop_repeats
from dockyard.llm.tables import staged


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model doesn't reject."""
    return drop_rejected(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs, keep="max")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return drop_near(docs, words=5, percent=80)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without strings of 50 bytes that documents with smaller ids have."""
    return drop_repeats(docs, length=50)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of up to 2048 tokens with their place in a sequence."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 2048, 0)


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near),
          ("suffix_dedup", repeats), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
