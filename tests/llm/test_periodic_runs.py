"""Runs of words against the definition."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
from rows import documents, with_clashing_columns

from replylens.llm import periodic_runs
from replylens.llm.queries import op13_periodic_runs


def plain_runs(words):
    """[(start, length, period)]: every lag, every stretch, the smallest period of each."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i + period - start
            if length >= max(6, 4 * period):
                found.setdefault((start, length), period)
            i += i == start
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def report(doc_id, words):
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    times = best[1] and 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, times, sha(lines), sha(plain_collapsed(words, runs)))


def random_words(rng):
    words = []
    while rng.random() < 0.8:
        letters = rng.choice([1, 2, 3, 50])
        if rng.random() < 0.5:
            words += [rng.randrange(letters) for _ in range(rng.randrange(40))]
        else:
            period = rng.choice([1, 2, 3, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 40, 64])
            root = [rng.randrange(letters) for _ in range(period)]
            words += (root * 8)[: int(period * rng.uniform(2, 7))]
    return words


def test_random_documents():
    rng = random.Random(13)
    for _ in range(300):
        docs = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        assert periodic_runs.find_runs([np.array(d, np.int64) for d in docs]) == [plain_runs(d) for d in docs]


def test_runs_at_the_limits_of_every_scale():
    rng = random.Random(5)
    for period in range(1, 140):
        for length in {4 * period - 1, 4 * period, 4 * period + 1, 5, 6}:
            root = [rng.randrange(1000, 9000) for _ in range(period)]
            words = [1, 2, 3] + (root * (length // period + 1))[:length] + [4, 5]
            assert periodic_runs.find_runs([np.array(words)]) == [plain_runs(words)]


def test_long_texts_take_near_linear_time():
    words = {
        "one word": np.zeros(300_000, np.int64),
        "two words": np.random.default_rng(0).integers(0, 2, 300_000),
        "long period": np.tile(np.arange(3000), 100),
    }
    for name, text in words.items():
        began = time.time()
        runs = periodic_runs.find_runs([text])[0]
        assert time.time() - began < 10, name
        assert (0, 300_000, 1 if name == "one word" else 3000) in runs or name == "two words"


TEXTS = [
    None, "", " \t\n ", "a", "a a a a a", "a a a a a a", "x y " * 3, "x y " * 4, "A a A a A a A a", "q " + "l m n " * 5 + "l z",
    "a b a b a b a b a b a b", "é ü " * 9, "a a a a b a a a a b a a a a b a a a a b", "x y " * 4,
]


def test_report_on_awkward_rows(spark):
    docs = documents(spark, TEXTS)
    docs = with_clashing_columns(docs.unionByName(docs.limit(3)).withColumn("runs", docs.n_chars).withColumn("best", docs.n_chars))
    got = sorted(map(tuple, periodic_runs.runs_report(docs).collect()))
    words = lambda t: (t or "").encode().split()
    expected = [report(i, [w.decode() for w in words(t)]) for i, t in enumerate(TEXTS)]
    assert got == sorted(expected + expected[:3])


def test_null_ids_and_empty_table(spark):
    docs = documents(spark, ["b " * 9]).selectExpr("cast(null as long) as doc_id", "text")
    assert [r.n_runs for r in periodic_runs.runs_report(periodic_runs.with_planted_periods(docs)).collect()] == [1]
    assert periodic_runs.runs_report(docs.limit(0)).collect() == []


def test_query_against_plain_version(spark):
    sf = "/root/testdata/sf0.001"
    given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = [report(r.doc_id, planted(r.doc_id, [w.decode() for w in (r.text or "").encode().split()])) for r in given]
    assert sorted(map(tuple, op13_periodic_runs(spark, sf).collect())) == sorted(expected)
