"""Token counts through a cache of digests.

A text is normalised (null is empty, white space at both ends goes, which the tokenizer drops too)
and digested; the tokenizer's file has a digest of its own, its version. Distinct contents that the
cache has no count for are encoded once and appended to it; counts are then joined by digest.

The cache is a Parquet table (version, digest, n_tokens) in a folder that all executors reach, and
may be kept from run to run. Only digests meet the cache: they are aggregated, which combines copies before
the shuffle, and joined to the stored ones; one row per missing digest is chosen, and only these rows' texts are
fetched. With a full cache no text is shuffled at all. The final join by digest is over narrow rows, and splits hot
digests.

The tokenizer removes white space and matches within words only, so in a task counts are kept per
word, and the library encodes the words that the task has not seen.

Defined cases: null text has 0 bytes and 0 tokens; repeated rows are counted each; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.session import cut_lineage

CACHE = "version string, digest binary, n_tokens long"
WORDS_KEPT = 500_000
SLICE = 1 << 20
RULE = "outer-space-1"


def normalised(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\x0b\f"))


def slices(data: bytes, size: int = SLICE):
    """Parts of about `size` bytes that end at white space."""
    start = 0
    while start < len(data):
        end = start + size
        while end < len(data) and data[end] not in b" \t\n\r\x0b\f":
            end += 1
        yield data[start:end]
        start = end


class WordCounter:
    """Tokens of a text as the sum over its words, each encoded once while it is remembered."""

    def __init__(self, tokenizer_json: str, kept: int = WORDS_KEPT):
        from tokenizers import Tokenizer

        self.tokenizer, self.kept, self.known = Tokenizer.from_str(tokenizer_json), kept, {}

    def count(self, text: str) -> int:
        return sum(self.count_words(part.split()) for part in slices(text.encode()))

    def count_words(self, words: list[bytes]) -> int:
        known = self.known
        missing = list({w for w in words if w not in known})
        if missing:
            if len(known) > self.kept:
                known.clear()
                missing = list(set(words))
            encoded = self.tokenizer.encode_batch_fast([w.decode() for w in missing], add_special_tokens=False)
            known.update(zip(missing, map(len, encoded), strict=True))
        return sum(map(known.__getitem__, words))


def _missing_contents(texts: DataFrame, narrow: DataFrame, stored: DataFrame) -> DataFrame | None:
    """(digest, content) once for each digest of `narrow` that is not `stored`; None if there is none.

    One row per missing digest is chosen; rows of equal digest and id have equal contents.
    """
    found = narrow.groupBy("digest", "doc_id").agg(F.count("*").alias("n")).groupBy("digest").agg(F.min(F.struct("doc_id", "n")).alias("row"))
    missing = found.join(stored.select("digest"), "digest", "left_anti")
    missing = cut_lineage(missing.select(F.col("digest").alias("missing"), F.col("row.doc_id").alias("found_in"), "row.n"))
    if missing.isEmpty():
        return None
    same = (F.col("digest") == F.col("missing")) & F.col("doc_id").eqNullSafe(F.col("found_in"))
    fetched = texts.join(missing, same).select("digest", "content", "n")
    # Only where a row repeats with its id can a content come more than once.
    if missing.filter("n > 1").isEmpty():
        return fetched
    return fetched.filter("n = 1").unionByName(fetched.filter("n > 1").dropDuplicates(["digest"]))


def count_tokens(docs: DataFrame, tokenizer_file: str, cache: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; appends new contents to `cache`.

    `tokenizer_file` is read on the driver and sent to the executors: its size is that of a vocabulary.
    """
    spark = docs.sparkSession
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = f.read()
    version = hashlib.sha256((RULE + definition).encode()).hexdigest()
    sent = spark.sparkContext.broadcast(definition)

    def encode(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = WordCounter(sent.value)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    spark.createDataFrame([], CACHE).write.mode("ignore").parquet(cache)
    content = normalised(F.col("text"))
    texts = docs.select("doc_id", content.alias("content"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    narrow = cut_lineage(docs.select("doc_id", n_bytes.alias("n_bytes"), F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest")))
    stored = lambda: spark.read.schema(CACHE).parquet(cache).filter(F.col("version") == version)
    if stored().isEmpty():
        # Nothing to join: copies are combined before the shuffle, and each content is encoded.
        missing = texts.groupBy("digest").agg(F.first("content").alias("content"))
    else:
        missing = _missing_contents(texts, narrow, stored())
    if missing is not None:
        counted = missing.select("digest", "content").mapInArrow(encode, "digest binary, n_tokens long")
        counted.select(F.lit(version).alias("version"), "digest", "n_tokens").write.mode("append").parquet(cache)
    # Two runs at once may both have stored a content. Written, so that the join is one of plain exchanges,
    # which the adaptive execution splits where a digest is hot.
    counts = cut_lineage(stored().groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))
    return narrow.join(counts.hint("merge"), "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
