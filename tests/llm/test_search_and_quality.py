"""Nearest neighbours against brute force, and importance resampling on labelled text."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from rows import SCHEMA, documents, with_clashing_columns

from replylens.llm import ann_search, quality_resample

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every=20):
    """{query: [(vec_id, score)]} over rows (vec_id, vector)."""
    good = [
        (i, np.array(v, np.float64)) for i, v in rows
        if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]
    ids = np.array([i for i, _ in good])
    matrix = np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            score = (matrix * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def recall(got, expected):
    hits = [len({i for i, _ in got[q]} & {i for i, _ in best}) for q, best in expected.items() if best]
    return sum(hits) / sum(len(best) for best in expected.values())


@pytest.mark.parametrize("sf,shard,per_block", [("sf0.01", 8192, 4096), ("sf0.1", 300, 50)])
def test_recall_on_given_vectors(spark, sf, shard, per_block):
    path = f"/root/testdata/{sf}/embeddings.parquet"
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{path}'").fetchall()
    df = ann_search.search(spark.read.parquet(path), F.col("vec_id") % 20 == 0, shard=shard, per_block=per_block)
    got, expected = found(df), brute(rows, 20)
    assert set(got) == set(expected) and all(len(got[q]) == 20 for q in got)
    assert recall(got, expected) >= 0.9
    exact = {(q, i): s for q, best in expected.items() for i, s in best}
    assert all(abs(s - exact[q, i]) < 1e-12 for q in got for i, s in got[q] if (q, i) in exact)
    assert all(best == sorted(best, key=lambda x: (-x[1], x[0])) for best in got.values())


def test_copies_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)], 0) for i in range(200)]
    rows += [(i, [1.0, 2.0, 0.0, 0.0, -1.0, 0.0, 0.0, 3.0], 0) for i in range(200, 500)]
    rows += [(500, None, 0), (520, [0.0] * 8, 0), (540, [1.0] * 7 + [None], 0), (560, [math.nan] * 8, 0), (580, [math.inf] + [1.0] * 7, 0)]
    rows += [(600, [1.0, 2.0], 0), (None, [1.0] * 8, 0), (40, [-0.0] * 8, 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit(1)).withColumn("cell", F.lit("x"))
    expected = brute([(i, v) for i, v, _ in rows if v is None or len(v) == 8], 5)
    got = found(ann_search.search(df, F.col("vec_id") % 20 == 0, k=5, recall=1.0, shard=16, per_block=4))
    assert set(got) == set(expected)
    assert recall(got, expected) >= 0.9
    assert all(got[q] == expected[q] for q in range(200, 500, 20))


def test_few_and_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0, 2.0], 0), (20, [2.0, 1.0], 0), (21, [3.0, 1.0], 1)], VECTORS)
    got = found(ann_search.search(one, F.col("vec_id") % 20 == 0))
    assert got == {0: [(21, 5.0), (20, 4.0)], 20: [(21, 7.0), (0, 4.0)]}
    assert ann_search.search(one.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert ann_search.search(one.filter("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_heap_visits_all_cells_in_order():
    rng = np.random.default_rng(0)
    sample = rng.normal(size=(500, 6))
    index = ann_search.MultiIndex(sample, 3000, 5)
    cells = index.cells(sample)
    occupied = np.bincount(cells, minlength=len(index.books[0]) * index.width)
    for q in sample[:20]:
        visited = index.visit(q, occupied, len(sample))
        scores = (index.books[0] @ q[:3])[:, None] + (index.books[1] @ q[3:])[None, :]
        assert sorted(visited) == np.flatnonzero(occupied).tolist()
        assert all(a >= b - 1e-12 for a, b in zip(scores.ravel()[visited], scores.ravel()[visited][1:], strict=False))


def labelled(spark, n=600, seed=4):
    rng = random.Random(seed)
    good, poor = [f"word{i}" for i in range(40)], [f"junk{i}" for i in range(20)]
    texts, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        words = rng.choices(poor if bad else good, k=rng.randint(20, 200))
        texts.append((" %%% " if bad else " ").join(words))
        if rng.random() < 0.4:
            labels.append((i, int(not bad), 0))
    return texts, labels


def test_resample_keeps_what_is_like_the_target(spark):
    texts, labels = labelled(spark)
    texts += [None, "", " ", texts[0], texts[0]]
    docs = with_clashing_columns(documents(spark, texts))
    rows = labels + [(None, 1, 0), (3, None, 0), (10**9, 0, 0)]
    given = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality_resample.resample(docs, given).collect()}
    assert len(got) == len(texts)
    wrong = [i for i in range(600) if got[i].taken != ("%%%" not in texts[i])]
    assert len(wrong) <= 3
    kept = quality_resample.keep_target_like(docs, given)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].taken}
    again = {r.doc_id: r.score for r in quality_resample.resample(docs, given).collect()}
    assert again == {i: got[i].score for i in got}


def test_gumbel_top_k(spark):
    rng = random.Random(0)
    scores = [rng.choice([rng.gauss(0, 1), rng.gauss(1000, 1e-6), 5.0]) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    for k in (1, 2, 700, 1500, 2999, 3000):
        assert quality_resample.kth_largest(df, k) == sorted(scores, reverse=True)[k - 1]


def test_weights_equal_plain_bag_models(spark):
    """Each document's weight against n-gram counts in dictionaries, without hashing."""
    texts, _ = labelled(spark, 60)
    texts[0] = "A_b 1!? é-é  x"
    ratios = np.random.default_rng(0).normal(size=quality_resample.BUCKETS)
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in quality_resample.log_weights(docs, ratios, 0).collect()}
    import re

    names, value = {}, {}
    for i, text in enumerate(texts):
        words = re.findall(r"[\w]+|[^\w\s]+", text.lower())
        grams = [(w,) for w in words] + list(zip(words, words[1:], strict=False))
        assert got[i].n_grams == len(grams)
        names[i] = grams
    for _, owner, bucket in quality_resample.grams_of(texts):
        for o, b in zip(owner, bucket, strict=True):
            value.setdefault(o, []).append(ratios[b])
    assert all(math.isclose(got[i].log_weight, sum(value[i])) for i in names)


def test_without_labels_or_documents(spark):
    texts, labels = labelled(spark, 50)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_resample.resample(documents(spark, texts), none).filter("taken").count() == 50
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert quality_resample.resample(documents(spark, []), given).count() == 0


def test_held_out_accuracy(spark):
    """Trained on the labels of even documents, judged on those of odd ones."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_resample.resample(spark.read.parquet(f"{sf}/documents.parquet"), labels.filter("doc_id % 2 = 0"))
    judged = scored.join(labels.filter("doc_id % 2 = 1"), "doc_id").groupBy("quality").agg(F.avg(F.col("taken").cast("int")).alias("share"))
    share = {r.quality: r.share for r in judged.collect()}
    assert share[1] > 0.99 and share[0] < 0.1


def test_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b", "en", "s", 1), (1, "a b c", None, None, None), (1, "a b c", None, None, None)], SCHEMA)
    given = spark.createDataFrame([(1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality_resample.resample(docs, given).count() == 3
