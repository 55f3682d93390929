"""Exports of the pair table as a stream: one delivery per micro-batch, polled, retried, known by its number."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replylens.blueprint import Blueprint
from replylens.operators.buckets import bucket_metrics
from replylens.session import cut_lineage, temporary_stages
from replylens.sources.tables import batch_ids, pair_schema, read_batches, write_batch

POLL_SECONDS, LONGEST_WAIT = 5.0, 300.0
MARKS = "pair_batch bigint"


def _export_new(spark: SparkSession, bp: Blueprint, root: str, deliver) -> int:
    """Deliver what complete batches of pairs have brought since the last call; returns the deliveries."""
    marks, done = f"{root}/export_marks", f"{root}/exports"
    taken = max((r.pair_batch for r in read_batches(spark, marks, MARKS).collect()), default=-1)
    new = [b for b in batch_ids(spark, f"{root}/pairs") if b > taken]
    if not new:
        return 0
    before = len(batch_ids(spark, done))

    def step(pairs: DataFrame, number: int) -> None:
        if number in batch_ids(spark, done):
            return
        with temporary_stages(spark):
            rows = cut_lineage(pairs)
            if not rows.isEmpty():
                deliver(bucket_metrics(rows, bp), number)
            write_batch(rows.select("pair_id", F.current_timestamp().alias("exported_at")), done, number)

    names = ",".join(map(str, new))
    arriving = spark.readStream.schema(pair_schema(bp)).parquet(f"{root}/pairs/batch_id={{{names}}}")
    writer = arriving.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/_progress/export")
    writer.trigger(availableNow=True).start().awaitTermination()
    write_batch(spark.createDataFrame([(max(new),)], MARKS), marks, max(batch_ids(spark, marks), default=-1) + 1)
    return len(batch_ids(spark, done)) - before


def export_poll(
    spark: SparkSession, bp: Blueprint, root: str, deliver, poll_seconds: float = POLL_SECONDS, polls: int | None = None,
    attempts: int | None = None, wait=time.sleep,
) -> int:
    """Call `deliver(buckets, number)` for the bucket rows of new pairs, polling `polls` times (None: for ever).

    A failed delivery is tried again at the next poll, with the same pairs under the same number, because the
    checkpoint has planned them; so a receiver that keeps one delivery per number gets each pair once, also
    after a crash between the delivery and its record in <root>/exports. Waits double with every failure in
    a row, up to `LONGEST_WAIT`; after `attempts` failures in a row (None: never) the error is raised.
    Returns the number of deliveries. The ledger has one exporter: this one, or `tables.export_once`.
    """
    if poll_seconds <= 0 or (attempts is not None and attempts < 1):
        raise ValueError("poll interval and attempts must be positive")
    made, failed, done = 0, 0, 0
    while polls is None or done < polls:
        try:
            made += _export_new(spark, bp, root, deliver)
            failed, done = 0, done + 1
        except StreamingQueryException:
            failed += 1
            if attempts is not None and failed >= attempts:
                raise
        if polls is None or done < polls:
            wait(min(LONGEST_WAIT, poll_seconds * 2 ** max(0, failed - 1)))
    return made
