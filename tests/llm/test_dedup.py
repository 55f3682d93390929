"""Exact and near dedup against comparisons of all pairs, and the cases without links."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from brute import near_duplicate_rows, shingle_set
from rows import SCHEMA, documents, with_clashing_columns

from replylens.llm import exact_dedup, minhash_dedup, tokens
from replylens.llm.components import components

AWKWARD = [None, "", " \n\t", "one", "One", "one two three four", "ONE  two\nthree four", "É one", "é one", "a b c d e", "A B C D E F"]


def near_texts(seed=3, families=12, size=9, words=120):
    """Families of texts with a few words changed, some beyond the limit, and passages they share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    passage = [word() for _ in range(60)]
    texts = []
    for f in range(families):
        base = [word() for _ in range(rng.choice([8, 40, words, 600]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy + (passage if f % 3 == 0 else [])))
    return texts


def test_exact_groups(spark):
    texts = AWKWARD + ["x" * 5000 + "a", "X" * 5000 + "a", "x" * 5000 + "b", "y" * 20000, "y" * 20000, "same"] + ["same"] * 3
    docs = with_clashing_columns(documents(spark, texts))
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    got = exact_dedup.exact_groups(docs, first=2, growth=3).collect()
    assert len(got) == len(texts)
    for r in got:
        same = [i for i, t in enumerate(texts) if lower(t) == lower(texts[r.doc_id])]
        assert (r.keep_id, r.group_size, r.kept) == (max(same), len(same), r.doc_id == max(same))
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert exact_dedup.exact_groups(documents(spark, [])).count() == 0


def test_exact_with_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "b"), (None, None), (2, "A")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = exact_dedup.exact_groups(docs).collect()
    assert Counter((r.keep_id, r.group_size, r.kept) for r in got) == {
        (2, 3, True): 1, (2, 3, False): 2, (1, 2, True): 1, (1, 2, False): 1, (None, 1, True): 1,
    }
    assert exact_dedup.drop_exact_copies(docs).count() == 3


def test_token_hashes_slice_long_texts(monkeypatch):
    text = "The é QUICK\tbrown\x0bfox  \n " * 300
    whole = [h for _, _, h in tokens.token_hashes([text, "the"], tokens.WORDS)]
    monkeypatch.setattr(tokens, "SLICE", 50)
    parts = [h for _, _, h in tokens.token_hashes([text, "the"], tokens.WORDS)]
    assert np.array_equal(np.concatenate(whole), np.concatenate(parts))
    assert len(np.unique(np.concatenate(whole))) == 5


def test_signature_words_and_keys():
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 1 << 16, (200, minhash_dedup.HASHES)).astype(np.uint16)
    assert np.array_equal(minhash_dedup.symbols_from(minhash_dedup.planes_of(symbols)), symbols)
    # Pigeonhole: any two signatures within DISTANCE share a key.
    for row in symbols:
        other = row.copy()
        changed = rng.choice(minhash_dedup.HASHES, minhash_dedup.DISTANCE, replace=False)
        other[changed] ^= rng.integers(1, 1 << 16, len(changed)).astype(np.uint16)
        keys = minhash_dedup.keys_of(np.array([row, other]))
        assert (keys[0] == keys[1]).any()


@pytest.mark.parametrize("rounds", [0, 3])
def test_near_duplicates(spark, rounds):
    texts = AWKWARD + near_texts() + ["same old text of five or more words"] * 5
    docs = with_clashing_columns(documents(spark, texts))
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(docs, rounds=rounds).collect()}
    expected = near_duplicate_rows(list(enumerate(texts)))
    assert [(i, got[i].n_shingles, got[i].component_id) for i in range(len(texts))] == expected
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_near_duplicates_of_sample_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall()
    got = minhash_dedup.near_duplicates(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(near_duplicate_rows(docs))


def test_near_duplicates_with_repeated_and_null_ids(spark):
    text, other = near_texts(families=2, size=1)
    rows = [(5, text), (5, text), (5, other), (3, other + " x"), (None, text), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in got) == {
        (5, 5, True): 2, (5, 3, False): 1, (3, 3, True): 1, (None, 5, False): 1, (None, None, True): 1,
    }
    kept = minhash_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == {5: 1, 3: 1, None: 1}
    assert minhash_dedup.near_duplicates(documents(spark, [])).count() == 0


def test_shingle_counts():
    texts = AWKWARD + near_texts(families=4) + ["a a a a a a a a b"]
    got = [len(s) for s in minhash_dedup.shingles_of(texts)]
    assert got == [len(shingle_set(t)) for t in texts]


def test_components(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(200, i) for i in range(201, 260)]
    noise = [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(70)]
    edges = chain + star + noise
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for n in parent if any(n in e and e[0] != e[1] for e in edges)}
