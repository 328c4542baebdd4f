"""The registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateloom.llm.common import shared_folder
from rateloom.llm.embedding_dedup import near_embeddings
from rateloom.llm.fingerprints import fingerprint_documents
from rateloom.llm.language import held_out, identify_documents
from rateloom.llm import exact_search, hard_negatives, lexical_search, mixing
from rateloom.llm.packing import pack
from rateloom.llm.quality import score_documents
from rateloom.llm.simhash_dedup import simhash_groups
from rateloom.llm.span_dedup import drop_repeated_passages
from rateloom.llm.surrogates import replace_entities
from rateloom.llm.token_files import digest, read_token_file, write_token_file


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors, whatever their labels."""
    return near_embeddings(_table(spark, sf_dir, "embeddings"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of the sources takes of every document."""
    return mixing.mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated passages."""
    return drop_repeated_passages(_table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return pack(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    found = score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "held_out", F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted")
    )


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data and secrets."""
    return replace_entities(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    found = identify_documents(_table(spark, sf_dir, "documents"), vocabulary_path("piece_bpe_32k.model"))
    return found.select(
        "doc_id", held_out(4, 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as a token file, read back."""
    path = f"{shared_folder(spark)}/llm-tokens-{uuid.uuid4().hex}"
    write_token_file(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"), path)
    return digest(read_token_file(spark, path))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-copy component of every document."""
    groups = simhash_groups(_table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op11_exact_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest inner products of every hundredth vector."""
    return exact_search.top_products(_table(spark, sf_dir, "embeddings"))


def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return lexical_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector's positives."""
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_mix_sources": op2_mix_sources,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality": op6_quality,
    "op7_surrogates": op7_surrogates,
    "op8_language_id": op8_language_id,
    "op9_token_files": op9_token_files,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_exact_top_k_search": op11_exact_top_k_search,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_hard_negative_mining": op13_hard_negative_mining,
}

ORACLE: dict[str, str] = {
    "op2_mix_sources": mixing.oracle(),
    "op11_exact_top_k_search": exact_search.oracle(),
    "op12_ranked_lexical_search": lexical_search.oracle(),
    "op13_hard_negative_mining": hard_negatives.oracle(),
}
