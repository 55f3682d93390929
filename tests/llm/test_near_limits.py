"""Near dedup at other limits than the query's, and components whose ids repeat or are null."""

import numpy as np
import pytest
from brute import near_duplicate_rows
from rows import SCHEMA, documents
from test_dedup import near_texts

from replylens.llm import minhash_dedup


@pytest.mark.parametrize("least,cuts", [(85, (13, 25)), (80, (16, 31))])
def test_chunks_and_distance_of_a_limit(least, cuts):
    assert minhash_dedup.cuts(least) == cuts
    chunks, distance = cuts
    rng = np.random.default_rng(0)
    symbols = rng.integers(0, 1 << 16, (200, minhash_dedup.HASHES)).astype(np.uint16)
    for row in symbols:
        other = row.copy()
        changed = rng.choice(minhash_dedup.HASHES, distance, replace=False)
        other[changed] ^= rng.integers(1, 1 << 16, distance).astype(np.uint16)
        keys = minhash_dedup.keys_of(np.array([row, other]), chunks)
        assert (keys[0] == keys[1]).any()


def test_near_duplicates_from_80_percent(spark):
    texts = near_texts(seed=5, families=8)
    got = minhash_dedup.near_duplicates(documents(spark, texts), least_percent=80).collect()
    expected = near_duplicate_rows(list(enumerate(texts)), least=80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(expected)
    assert expected != near_duplicate_rows(list(enumerate(texts)))


def test_one_row_stays_of_a_component_with_repeated_or_null_ids(spark):
    text = near_texts(families=2, size=1)[1]
    rows = [(5, text), (5, text + " x"), (5, text + " x"), (9, text + " y"), (None, text + " z")]
    other = " ".join(f"w{i}" for i in range(90))
    rows += [(None, other), (None, other + " x"), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)
    kept = [(r.doc_id, r.text) for r in minhash_dedup.drop_near_copies(docs).collect()]
    assert len(kept) == 3 and (None, None) in kept
    assert [t.startswith(text) for i, t in kept if i == 5] == [True]
    assert [t.startswith(other) for i, t in kept if i is None and t] == [True]
