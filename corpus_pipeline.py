"""Documents to training tokens: quality, exact copies, near copies, source mix, token ids.

Every stage takes all rows that the one before it kept and returns the columns of `documents`; the
last one returns token ids with the digests that prove them. Stages hand over Parquet tables in the
folder that the session names for checkpoints, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from replylens.llm import bpe_tree, exact_dedup, minhash_dedup, quality_resample, source_mix
from replylens.session import cut_lineage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes; the labels of `sf_dir` show the target."""
    return quality_resample.keep_target_like(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies, the document with the smallest doc_id."""
    return minhash_dedup.drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return source_mix.mix_sources(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, digests of the ids and of the decoded bytes, and the ids."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_tree.encode_documents(docs, ranks, public_tokenizers.PATTERN, keep=("doc_id", "source"), with_ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("minhash near-dedup", near_copies),
    ("mix sources", mix),
    ("byte-level bpe", token_ids),
]

# Hashed n-gram models, Gumbel noise and merges by rank are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
