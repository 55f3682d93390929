"""Quality classification by importance resampling.

Two bag models over hashed n-grams of words and marks, one of the target text (documents labelled
good, at most `LABELLED` of them) and one of the raw text (all documents), give each document the weight

    log_weight = sum over its n-grams of log p_target - log p_raw.

Documents are then drawn without replacement in proportion to exp(log_weight): `score` adds Gumbel
noise to the log weight, and the k largest scores are the sample. k is no fraction given in advance
but the number of documents whose weight is above the threshold that errs least on the labelled
documents (errors on either class weighted by its size), so the sample keeps what is like the target
and nothing else.

The raw model counts all documents. The target model is fitted on one half of at most `LABELLED`
labels, drawn by a hash of the id, and the threshold on the other half, whose weights are as little
flattered as those of documents without a label. The labels are sent to the tasks, so no text is shuffled.
Counts combine per task to one row per bucket. The models have `BUCKETS` numbers each and are sent to the tasks; the threshold comes from a histogram of
the labelled documents' weights in steps of fixed size, over their whole range. The k-th score is found by narrowing the range of scores in histograms of fixed size, so
no task sorts all of them.

Defined cases: null text counts as empty; documents without n-grams have weight 0; a document with
several labels is good if none says otherwise, rows with a null label are not labels; without labels
all documents are taken; noise depends on doc_id, text and seed, so repeated rows share it, and of
equal scores at the limit all are taken; an empty table gives an empty result; other columns are kept
by `keep_target_like` and ignored otherwise.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.llm import tokens
from replylens.llm.keeping import as_rows
from replylens.session import cut_lineage

BUCKETS = 1 << 14
GRAMS = 2
SMOOTHING = 3.0
LABELLED = 50_000
# Log weights per document are compared in steps of STEP.
STEP = 0.5
CELLS = 1024


def grams_of(texts, buckets: int = BUCKETS, n: int = GRAMS):
    """Yields (first, document of each n-gram, bucket of each n-gram) for runs of texts."""
    shift = np.uint64(64 - (buckets - 1).bit_length())
    for first, ends, hashes in tokens.token_hashes(texts, tokens.WORDS_AND_MARKS):
        document = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        owners, found = [document], [tokens.mix(hashes) >> shift]
        running = hashes
        for size in range(2, n + 1):
            running = tokens.mix(running[:-1] * tokens.BASE + hashes[size - 1 :])
            same = document[: len(running)] == document[size - 1 :]
            owners.append(document[: len(running)][same])
            found.append(running[same] >> shift)
        yield first, np.concatenate(owners), np.concatenate(found).astype(np.int64)


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, raw, target): n-grams of all rows and of those with `good`."""

    def run(batches):
        import pyarrow as pa

        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            good = np.array(batch.column(1).fill_null(False).to_pylist(), bool)
            for first, owner, bucket in grams_of(batch.column(0).to_pylist(), buckets):
                raw += np.bincount(bucket, minlength=buckets)
                target += np.bincount(bucket[good[first + owner]], minlength=buckets)
        used = np.flatnonzero(raw)
        columns = [pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    counted = docs.select("text", "good").mapInArrow(run, "bucket int, raw long, target long")
    return counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING) -> np.ndarray:
    """log p_target - log p_raw per bucket; at most `buckets` rows come to the driver."""
    table = counts.toPandas()
    raw, target = np.zeros(buckets), np.zeros(buckets)
    raw[table["bucket"]], target[table["bucket"]] = table["raw"], table["target"]
    if not target.any():
        return np.zeros(buckets)
    # Smoothing towards the raw text: what the labelled target has not seen says little against a text.
    p_raw = (raw + 1) / (raw.sum() + buckets)
    return np.log(target + smoothing * buckets * p_raw) - np.log(target.sum() + smoothing * buckets) - np.log(p_raw)


def label_sample(labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(_label_id, good, fits) of at most `most` labelled documents; the draw depends on ids alone."""
    known = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_label_id"))
        .agg((F.min("quality") > 0).alias("good"))
    )
    drawn = known.orderBy(F.xxhash64("_label_id"), "_label_id").limit(most)
    return drawn.withColumn("fits", F.pmod(F.xxhash64("_label_id", F.lit(1)), F.lit(2)) == 0)


def with_labels(docs: DataFrame, sample: DataFrame, fits: bool) -> DataFrame:
    """`docs` with `good`: true, false, or null for documents without a label in that half of `sample`."""
    sample = sample.filter(F.col("fits") == fits).drop("fits")
    return docs.join(F.broadcast(sample), F.col("doc_id") == F.col("_label_id"), "left").drop("_label_id")


def log_weights(docs: DataFrame, ratios: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, text_key, n_grams, log_weight, noise) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        import pyarrow as pa

        ratio = sent.value
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            weight = np.zeros(batch.num_rows)
            for first, owner, bucket in grams_of(batch.column(2).to_pylist(), len(ratio)):
                size = int(owner.max()) + 1 if len(owner) else 0
                n[first : first + size] += np.bincount(owner, minlength=size)
                weight[first : first + size] += np.bincount(owner, weights=ratio[bucket], minlength=size)
            columns = [batch.column(0), batch.column(1), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "n_grams", "log_weight"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    scored = rows.mapInArrow(run, f"doc_id {id_type}, text_key long, n_grams long, log_weight double")
    drawn = F.xxhash64("doc_id", "text_key", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))
    uniform = (drawn.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))
    return scored.withColumn("noise", -F.log(-F.log(uniform)))


def threshold(scored: DataFrame, sample: DataFrame) -> float | None:
    """The weight from which documents count as like the target; None without labels of both kinds.

    Minus infinity if taking all errs least. One row per step that labelled documents reach comes out of
    the aggregation, so no more than there are labels in that half, if ids do not repeat.
    """
    cell = F.floor(F.col("log_weight") / STEP)
    cells = (
        with_labels(scored, sample, False)
        .filter("good IS NOT NULL")
        .groupBy(cell.alias("cell"))
        .agg(F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("poor"))
        .toPandas()
        .sort_values("cell")
    )
    good, poor = cells["good"].to_numpy(), cells["poor"].to_numpy()
    if not good.sum() or not poor.sum():
        return None
    # Cutting below cell i loses the good before it and takes the poor from it on. Of equal cuts the
    # lowest: clean documents stay.
    lost = (np.cumsum(good) - good) / good.sum()
    taken = (poor.sum() - (np.cumsum(poor) - poor)) / poor.sum()
    best = int(np.argmin(lost + taken))
    return float(cells["cell"].to_numpy()[best] * STEP) if best else -math.inf


def kth_largest(scored: DataFrame, k: int) -> float:
    """The k-th largest `score`, by histograms of CELLS cells over ever narrower ranges."""
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    above = 0
    while low < high:
        width = (high - low) / CELLS
        if width == 0 or low + width == low:
            return low
        cell = F.least(F.floor((F.col("score") - F.lit(low)) / F.lit(width)), F.lit(CELLS - 1))
        inside = scored.filter(F.col("score").between(low, high)).groupBy(cell.alias("cell"))
        cells = inside.agg(F.count("*").alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
        for row in cells.orderBy(F.desc("cell")).collect():
            if above + row.n >= k:
                low, high = row.low, row.high
                break
            above += row.n
    return low


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, text_key, n_grams, log_weight, score and `taken`, one row per document."""
    sample = cut_lineage(label_sample(labels))
    ratios = log_ratios(gram_counts(with_labels(docs.select("doc_id", "text"), sample, True)))
    scored = cut_lineage(log_weights(docs, ratios, seed)).withColumn("score", F.col("log_weight") + F.col("noise"))
    least = threshold(scored, sample)
    if least is None:
        return scored.drop("noise").withColumn("taken", F.lit(True))
    k = scored.filter(F.col("log_weight") >= least).count()
    taken = F.col("score") >= kth_largest(scored, k) if k else F.lit(False)
    return scored.drop("noise").withColumn("taken", taken)


def keep_target_like(docs: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """The rows of `docs` that are taken, with its columns."""
    rejected = resample(docs, labels, seed).filter("NOT taken").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("row.text") == F.col("key"))
    return as_rows(docs).join(rejected.distinct().hint("merge"), same, "left_anti").select("row.*")
