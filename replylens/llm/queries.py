"""One registered query per operator, with production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replylens.llm import (
    ann_search,
    bpe_tree,
    chat_format,
    exact_dedup,
    html_extract,
    minhash_dedup,
    periodic_runs,
    prefix_trie,
    quality_resample,
    secret_scan,
    source_mix,
    tile_dedup,
    token_count,
)
from replylens.session import scratch_path

PROBE = "\\### Assistant: </turn> ok"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark, sf_dir):
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op2_chat_format(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(PROBE).alias("text")
    )
    return chat_format.chat_report(given.unionByName(probe))


def op3_secret_scan(spark, sf_dir):
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op4_token_count(spark, sf_dir):
    """With a new cache, so that every distinct content is encoded."""
    cache = scratch_path(spark, "token-cache")
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), cache)


def op5_ann_search(spark, sf_dir):
    return ann_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_exact_dedup(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_groups(documents).drop("text_key")


def op7_quality_resample(spark, sf_dir):
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_resample.resample(documents, labels).drop("text_key")


def op8_bpe_tree(spark, sf_dir):
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe_tree.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_source_mix(spark, sf_dir):
    return source_mix.mix_report(table(spark, sf_dir, "documents"))


def op10_html_extract(spark, sf_dir):
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark, sf_dir):
    turns = prefix_trie.conversation_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(prefix_trie.with_shared_heads(turns))


def op12_tile_dedup(spark, sf_dir):
    return tile_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return periodic_runs.runs_report(periodic_runs.with_planted_periods(documents))


QUERIES = {
    f.__name__: f
    for f in (
        op1_minhash_dedup,
        op2_chat_format,
        op3_secret_scan,
        op4_token_count,
        op5_ann_search,
        op6_exact_dedup,
        op7_quality_resample,
        op8_bpe_tree,
        op9_source_mix,
        op10_html_extract,
        op11_prefix_trie,
        op12_tile_dedup,
        op13_periodic_runs,
    )
}
