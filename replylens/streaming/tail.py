"""Continuous ingestion and matching.

A micro-batch is matched together with the events that earlier batches left unmatched. What
is still unmatched afterwards is written as the next residual. All state is in tables written
per batch, so a repeated batch after a failure gives the same result.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from replylens.blueprint import Blueprint
from replylens.operators.buckets import bucket_time, buckets_from_counts
from replylens.operators.correlate import correlate, pending
from replylens.operators.dedup import columns_as_fields, payload, with_event_hash
from replylens.operators.events import REQUEST, normalise, valid_events
from replylens.sources.tables import (
    batch_ids,
    drop_batches,
    event_schema,
    pair_schema,
    read_batches,
    store_events,
    write_batch,
)
from replylens.session import cut_lineage, temporary_stages
from replylens.streaming.state import count_in_state, keyed_state


class CarryOver:
    """The `foreachBatch` step: flat records -> stored events -> pairs and residual.

    With `lateness` None an unmatched event stays matchable forever. Otherwise requests whose
    timeout ended more than `lateness` before the newest event are moved to `expired`, and
    responses older than `lateness` are dropped from the residual.
    """

    def __init__(self, bp: Blueprint, root: str, parse=None, lateness: timedelta | None = None, **options):
        self.bp, self.root, self.parse, self.lateness, self.options = bp, root, parse, lateness, options

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        with temporary_stages(records.sparkSession):
            self._step(records, batch_id)

    def _step(self, records: DataFrame, batch_id: int) -> None:
        bp, root, spark = self.bp, self.root, records.sparkSession
        flat = self.parse(records) if self.parse else records
        fresh = store_events(normalise(flat, bp, keep=[], payload=True), bp, root, batch_id)
        path = f"{root}/residual"
        earlier = [b for b in batch_ids(spark, path) if b < batch_id]
        left = read_batches(spark, path, event_schema(bp)).filter(F.col("batch_id") == max(earlier, default=-1))
        events = fresh.filter(F.col("role").isNotNull()).unionByName(left.drop("batch_id"))
        write_batch(correlate(events, bp, **self.options), f"{root}/pairs", batch_id)
        pairs = read_batches(spark, f"{root}/pairs", pair_schema(bp)).filter(F.col("batch_id") == batch_id)
        unmatched = pending(events, pairs)
        if self.lateness is not None:
            unmatched = self._expire(unmatched, events, batch_id)
        write_batch(unmatched, path, batch_id)
        # The version before the current one is kept for a repeated batch.
        drop_batches(spark, path, max(earlier, default=-1))

    def _expire(self, unmatched: DataFrame, events: DataFrame, batch_id: int) -> DataFrame:
        newest = events.agg(F.max(F.unix_micros("event_ts"))).first()[0]
        if newest is None:
            return unmatched
        late_us = self.lateness // timedelta(microseconds=1)
        wait = F.when(F.col("role") == REQUEST, self.bp.timeout_us).otherwise(0)
        given_up = F.unix_micros("event_ts") + wait + late_us < newest
        expired = unmatched.filter(given_up & (F.col("role") == REQUEST))
        write_batch(expired, f"{self.root}/expired", batch_id)
        return unmatched.filter(~given_up)


def triggered(writer: DataStreamWriter, mode: str, poll_ms: int) -> DataStreamWriter:
    if mode not in ("batch", "tail"):
        raise ValueError("mode must be batch or tail")
    if poll_ms <= 0:
        raise ValueError("poll interval must be positive")
    return writer.trigger(availableNow=True) if mode == "batch" else writer.trigger(processingTime=f"{poll_ms} milliseconds")


def tail(
    records: DataFrame,
    bp: Blueprint,
    root: str,
    parse=None,
    mode: str = "tail",
    poll_ms: int = 1000,
    lateness: timedelta | None = None,
    **options,
):
    """Start the query. `batch` reads what is there and ends, `tail` keeps polling.

    With the files of a directory as source, the checkpoint holds which files were read.
    """
    step = CarryOver(bp, root, parse, lateness, **options)
    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/_progress/tail")
    return triggered(writer, mode, poll_ms).start()


def store_stream(events: DataFrame, bp: Blueprint, root: str, within: timedelta, mode: str = "tail", poll_ms: int = 1000):
    """Start storing streaming events (see `normalise`) once each, without reading what is stored.

    A copy is dropped if its event time is not more than `within` from that of the first one's arrival: Spark
    keeps the identities of that span as state. Batches, ids and columns are those of `store_events`.
    """
    if "payload" not in events.columns:
        events = events.withColumn("payload", payload(columns_as_fields(bp.carried_columns)))
    hashed = with_event_hash(valid_events(events), F.col("payload")).withColumn("event_date", F.to_date("event_ts"))
    span = f"{within // timedelta(microseconds=1)} microseconds"
    fresh = hashed.withWatermark("event_ts", span).dropDuplicatesWithinWatermark(["blueprint", "event_hash"])
    columns = [f.name for f in T.StructType.fromDDL(event_schema(bp)).fields if f.name != "event_id"]

    def keep(rows: DataFrame, batch_id: int) -> None:
        event_id = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), F.monotonically_increasing_id().alias("row"))
        by_day = rows.select(event_id.alias("event_id"), *columns).hint("rebalance", "event_date")
        write_batch(by_day, f"{root}/raw_events", batch_id, ("event_date",))

    writer = fresh.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/_progress/identities")
    return triggered(writer, mode, poll_ms).start()


# The newest response and the last batch of pairs that were taken in; times in microseconds.
MARKS = "newest bigint, pair_batch bigint"


def _pairs_arriving(spark: SparkSession, bp: Blueprint, root: str, batches: list) -> DataFrame:
    """Streams the pairs of `batches`, which are complete, and rows that only move the watermark.

    Files that an earlier run has taken are known to the checkpoint.
    """
    names = ",".join(map(str, batches))
    pairs = spark.readStream.schema(pair_schema(bp)).parquet(f"{root}/pairs/batch_id={{{names}}}")
    ends = spark.readStream.schema("response_ts timestamp").parquet(f"{root}/ends/batch_id=*")
    return pairs.unionByName(ends, allowMissingColumns=True)


def tumbling_metrics(
    spark: SparkSession, bp: Blueprint, root: str, lateness: timedelta = timedelta(0), mode: str = "tail"
) -> int:
    """Bucket rows of the pair table's batches that no run has taken in; returns their number.

    The counts of open buckets are streaming state (see `streaming.state`). A bucket is closed, and written,
    when the newest response is more than `lateness` past its end; pairs of a closed bucket add a row
    of their own with `late` set. Only batches that were written completely count, each once. `batch`
    closes all buckets at the end: a row at the end of the last one moves the watermark. `tail` leaves those
    behind the watermark open for the next call.
    """
    if mode not in ("batch", "tail"):
        raise ValueError("mode must be batch or tail")
    path = f"{root}/taken"
    run = max(batch_ids(spark, path), default=-1)
    last = next(iter(read_batches(spark, path, MARKS).filter(F.col("batch_id") == run).collect()), None)
    newest, taken = (last.newest, last.pair_batch) if last else (None, -1)
    new = [b for b in batch_ids(spark, f"{root}/pairs") if b > taken]
    if not new and (mode == "tail" or newest is None):
        return 0
    if last is None:
        write_batch(spark.createDataFrame([], "response_ts timestamp"), f"{root}/ends", 0)
    if new:
        arrived = read_batches(spark, f"{root}/pairs", pair_schema(bp)).filter(F.col("batch_id").isin(new))
        seen = bucket_time(arrived, bp).agg(F.max(F.unix_micros("response_ts"))).first()[0]
        newest = max([t for t in (newest, seen) if t is not None], default=None)
    if mode == "batch" and newest is not None:
        # Taken in with the last pairs; the watermark, and so what is late, changes after them.
        size = bp.bucket_seconds * 1_000_000
        end = newest - newest % size + size + lateness // timedelta(microseconds=1)
        mark = spark.range(1).select(F.timestamp_micros(F.lit(end)).alias("response_ts"))
        write_batch(mark, f"{root}/ends", run + 2)
    _count_buckets(spark, bp, root, lateness, new or [taken])
    write_batch(spark.createDataFrame([(newest, max([taken, *new]))], MARKS), path, run + 1)
    return len(new)


def _count_buckets(spark: SparkSession, bp: Blueprint, root: str, lateness: timedelta, batches: list) -> None:
    groups = ["bucket_start", *bp.dimension_columns, "late"]

    def close_buckets(rows: DataFrame, batch_id: int) -> None:
        with temporary_stages(spark):
            sums = [F.sum(c).alias(c) for c in ("n", "success_count", "error_count")]
            # The counts feed several branches of the percentile plan; they are written once.
            counts = cut_lineage(rows.groupBy(*groups, "latency_ms").agg(*sums))
            if not counts.isEmpty():
                write_batch(buckets_from_counts(counts, groups, bp), f"{root}/buckets", batch_id)

    with keyed_state(spark):
        counted = count_in_state(_pairs_arriving(spark, bp, root, batches), bp, lateness)
        writer = counted.writeStream.foreachBatch(close_buckets)
        writer.option("checkpointLocation", f"{root}/_progress/buckets").trigger(availableNow=True).start().awaitTermination()


def bucket_schema(bp: Blueprint) -> str:
    dims = "".join(f", `{c}` string" for c in bp.dimension_columns)
    return (
        f"bucket_start timestamp, bucket_seconds bigint{dims}, count bigint, success_count bigint, error_count bigint, "
        "min_latency_ms bigint, max_latency_ms bigint, avg_latency_ms double, p95_latency_ms bigint, "
        "p99_latency_ms bigint, success_rate double, error_rate double, throughput double, late boolean"
    )


def stored_buckets(spark: SparkSession, bp: Blueprint, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/buckets", bucket_schema(bp)).drop("batch_id")
