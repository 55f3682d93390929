"""The stages of the pipeline against plain versions, each on what the stage before kept."""

import math
from collections import Counter

import corpus_pipeline
import public_tokenizers
import tiktoken
from brute import near_duplicate_rows
from test_mix_and_chat import plain_targets

from replylens.llm import bpe_tree, quality_resample
from replylens.session import cut_lineage

SF = "/root/testdata/sf0.001"
RANKS = bpe_tree.read_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = docs.collect()
    outputs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
        outputs.append(docs.collect())
    quality, exact, near, mixed, tokens = outputs
    assert all(set(rows[0].asDict()) == set(given[0].asDict()) for rows in outputs[:4])

    taken = quality_resample.resample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert Counter(quality) == Counter(r for r in given if r.doc_id in {t.doc_id for t in taken.filter("taken").collect()})

    last = {}
    for r in quality:
        last[lower(r.text)] = max(r.doc_id, last.get(lower(r.text), r.doc_id))
    assert Counter(exact) == Counter(r for r in quality if last[lower(r.text)] == r.doc_id)

    components = near_duplicate_rows([(r.doc_id, r.text) for r in exact])
    stay = {doc_id for doc_id, _, component in components if doc_id == component}
    assert Counter(near) == Counter(r for r in exact if r.doc_id in stay)

    sizes = Counter()
    for r in near:
        sizes[r.source] += len((r.text or "").split())
    targets, repeats = plain_targets(sizes, (5, 2, 1)), Counter(r.doc_id for r in mixed)
    assert set(mixed) <= set(near) and max(repeats.values()) <= 3
    for source, target in targets.items():
        mine = [r for r in near if r.source == source]
        words = sum(repeats[r.doc_id] * len((r.text or "").split()) for r in mine)
        assert abs(words - target) <= 3 * max(len((r.text or "").split()) for r in mine)
        rate = target / sizes[source]
        assert all(math.floor(rate) <= repeats[r.doc_id] <= math.ceil(rate) for r in mine)

    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    ids = {r.doc_id: plain.encode_ordinary(r.text or "") for r in mixed}
    assert Counter((r.doc_id, tuple(r.ids)) for r in tokens) == Counter((r.doc_id, tuple(ids[r.doc_id])) for r in mixed)


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and rows.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert corpus_pipeline.ORACLE_SQL is None and set(corpus_pipeline.QUERIES) == {"pipeline"}


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
    assert docs.count() == 0
