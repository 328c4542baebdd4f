"""From the documents table to packed training sequences, stage by stage.

Every stage takes the documents that the one before kept and returns documents; the last returns the
pieces and their places in sequences. Each result is written to the shared folder and read again, so a
lost executor never costs more than a stage.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from rateloom.llm.common import written
from rateloom.llm.language import keep_identified
from rateloom.llm.mixing import mixed_documents
from rateloom.llm.packing import pack
from rateloom.llm.queries import vocabulary_path
from rateloom.llm.simhash_dedup import drop_near_copies
from rateloom.llm.surrogates import without_personal_data


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which no language is found."""
    return keep_identified(docs, vocabulary_path("piece_bpe_32k.model"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Surrogates in place of personal data and secrets."""
    return without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that a mix of the sources takes of every document."""
    return mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack(docs, vocabulary_path("word_bpe_49k.json"))


STAGES = [
    ("language id", language_id),
    ("simhash near-dedup", simhash_near_dedup),
    ("pii", pii),
    ("mix sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints, posteriors and token ids are beyond SQL; tests compare with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
