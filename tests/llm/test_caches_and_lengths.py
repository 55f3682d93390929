"""A token cache that is full already, and vectors of several lengths in one search."""

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from rows import documents

from replylens.llm import ann_search, bpe_tree, token_count

WORDS = public_tokenizers.path("word_bpe_49k.json")


def text_exchanges(df):
    """Exchanges in the plan of `df` that carry more than ids, counts and digests."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "text" in line]


def test_a_full_cache_encodes_and_shuffles_no_text(spark, tmp_path, monkeypatch):
    texts = [None, "", "one two", "one two", " one two ", "three", "three " * 5000]
    docs = documents(spark, texts)
    cache = str(tmp_path / "cache")
    first = sorted(map(tuple, token_count.count_tokens(docs, WORDS, cache).collect()))
    stored = spark.read.parquet(cache).count()
    assert stored == 4
    # A second run that had to encode anything would fail.
    monkeypatch.setattr(token_count.WordCounter, "count", None)
    again = token_count.count_tokens(docs.union(docs.filter("doc_id = 3")), WORDS, cache)
    assert sorted(map(tuple, again.collect())) == sorted([*first, first[3]])
    assert spark.read.parquet(cache).count() == stored
    assert text_exchanges(again) == []


def test_new_contents_of_repeated_rows_and_null_ids(spark, tmp_path):
    cache = str(tmp_path / "cache")
    docs = documents(spark, ["a b", "c"]).union(documents(spark, ["a b", "c d e"]))
    docs = docs.union(docs.withColumn("doc_id", F.lit(None).cast("long"))).union(docs)
    got = token_count.count_tokens(docs, WORDS, cache).collect()
    single = {r.doc_id: r.n_tokens for r in token_count.count_tokens(documents(spark, ["a b", "c", "c d e"]), WORDS, str(tmp_path / "b")).collect()}
    assert len(got) == 12 and sorted(r.n_tokens for r in got) == sorted([single[0], single[1], single[0], single[2]] * 3)
    assert spark.read.parquet(cache).count() == 3


def test_queries_of_a_rare_length(spark):
    """The queries have two components, most other vectors four: each length is searched by itself."""
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=2 if i % 20 == 0 or i % 7 == 0 else 4).tolist()) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann_search.search(df, F.col("vec_id") % 20 == 0, k=5, recall=1.0, shard=16, per_block=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    expected = {}
    for q, v in rows[::20]:
        scores = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
        expected[q] = [(n + 1, i) for n, (_, i) in enumerate(scores[:5])]
    assert {q: sorted(r) for q, r in got.items()} == expected


def test_every_length_among_the_queries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=1 + i // 20 % 3).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann_search.search(df, F.col("vec_id") % 20 == 0, k=50, recall=1.0).groupBy("query_id").count().collect()
    assert {r.query_id: r["count"] for r in found} == {q: 39 for q in range(0, 120, 20)}


def test_shards_go_to_the_blocks_that_visit_them(spark):
    """Two far groups, searched for few neighbours: no entry of one group meets a question of the other."""
    rng = np.random.default_rng(8)
    centers = np.array([[9.0, 0, 9, 0], [-9, 0, -9, 0], [0, 9, 0, 9], [0, -9, 0, -9]])
    rows = [(i, (centers[i % 4] + 0.1 * rng.normal(size=4)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann_search.search(df, F.col("vec_id") % 20 == 0, k=3, recall=0.9, shard=40, per_block=2).collect()
    assert all(r.query_id % 4 == r.vec_id % 4 for r in got) and len(got) == 60


def test_a_pattern_without_known_cuts_is_refused():
    bpe = bpe_tree.TreeBpe(bpe_tree.read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read()), r"\s+|\S+", leaf=16)
    assert bpe.decode(bpe.encode("short text")) == b"short text"
    with pytest.raises(ValueError, match="safe cuts"):
        bpe.encode("a text that is longer than a leaf")
