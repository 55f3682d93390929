"""Keyed streaming state against one batch pass and an event loop."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from replylens import Blueprint
from replylens.operators.correlate import correlate
from replylens.sources import tables
from replylens.streaming import state as K
from replylens.streaming import tail as S

BP = Blueprint(
    name="state", key_field="key", request_type_field="kind", response_type_field="kind", request_value="q",
    response_value="p", timestamp_field="at", dimensions=("place",), status_field="status", success_values={"ok"},
    timeout=timedelta(seconds=30), granularity="1m",
)
EVENTS = "event_id long, correlation_key string, role string, event_ts timestamp, place string, status string"
LATENESS = timedelta(seconds=20)
START = 1_700_000_000


def events(rows):
    """[(key, role, seconds)] -> event rows."""
    return [(i, key, role, float(START + at), "x" if i % 2 else None, "ok" if i % 3 else "no") for i, (key, role, at) in enumerate(rows)]


def land(spark, folder, rows):
    made = spark.createDataFrame(rows, EVENTS.replace("event_ts timestamp", "event_ts double"))
    made.withColumn("event_ts", F.timestamp_micros((F.col("event_ts") * 1_000_000).cast("long"))).write.mode("append").parquet(folder)


def run(spark, root):
    arriving = spark.readStream.schema(EVENTS).parquet(f"{root}/in")
    K.tail_in_state(arriving, BP, root, LATENESS, mode="batch").awaitTermination()
    return K.stored_matches(spark, arriving, BP, root)


def plain_pairs(spark, root):
    given = spark.read.schema(EVENTS).parquet(f"{root}/in").filter("correlation_key <> 'end'")
    return {(r.request_id, r.response_id) for r in correlate(given, BP).collect()}


def test_shuffled_deliveries_with_restarts_equal_one_batch_pass(spark, tmp_path):
    rng, root = random.Random(2), str(tmp_path)
    rows = events(sorted(((f"k{rng.randrange(4)}", rng.choice("qqp"), rng.randrange(0, 400)) for _ in range(250)), key=lambda r: r[2]))
    rows = [(i, k, {"q": "request", "p": "response"}[r], *rest) for i, k, r, *rest in rows]
    order = sorted(rows, key=lambda r: r[3] + rng.uniform(0, 19))
    for part in (order[:120], order[120:], [(999, "end", "request", START + 1000.0, None, None)]):
        land(spark, f"{root}/in", [(*r[:3], float(r[3]), *r[4:]) for r in part])
        matched = run(spark, root)
    pairs = K.matched_pairs(matched, BP)
    assert {(r.request_id, r.response_id) for r in pairs.collect()} == plain_pairs(spark, root)
    batch = correlate(spark.read.schema(EVENTS).parquet(f"{root}/in").filter("correlation_key <> 'end'"), BP)
    assert {tuple(r) for r in pairs.collect()} == {tuple(r) for r in batch.select(*pairs.columns).collect()}
    # Every event has exactly one fate.
    fates = [i for r in matched.collect() for i in ([r.q.id] if r.q else []) + ([r.p.id] if r.p else [])]
    assert sorted(fates) == list(range(250))
    left = {r.event_id for r in K.given_up(matched, (K.EXPIRED, K.SHADOWED, K.ORPHAN)).collect()}
    assert left == set(range(250)) - {i for p in plain_pairs(spark, root) for i in p}


def test_timers_and_late_events(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", [(1, "a", "request", START + 0.0, None, None), (2, "b", "request", START + 90.0, None, None)])
    rows = run(spark, root).collect()
    # The watermark stands at 70: the request of `a` is past its timeout although nothing came for it.
    assert [(r.kind, r.q.id, r.p) for r in rows] == [("expired", 1, None)]
    # Behind the watermark: a row of its own. Ahead of it: matched over the restart.
    land(spark, f"{root}/in", [(3, "a", "response", START + 5.0, None, None), (4, "b", "response", START + 95.0, "y", "ok")])
    land(spark, f"{root}/in", [(5, "c", "request", START + 300.0, None, None)])
    kinds = {(r.kind, r.q and r.q.id, r.p and r.p.id) for r in run(spark, root).collect()}
    assert kinds == {("expired", 1, None), ("late", None, 3), ("pair", 2, 4)}
    assert [r.event_id for r in K.given_up(run(spark, root), (K.LATE,)).collect()] == [3]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    land(spark, f"{root}/in", [(1, "a", "request", START + 0.0, None, None), (2, "b", "request", START + 90.0, None, None)])
    run(spark, root)
    before = tables.batch_ids(spark, f"{root}/matched")
    assert run(spark, root).count() == 1
    assert tables.batch_ids(spark, f"{root}/matched") == before


def test_a_replayed_delivery_adds_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    schema = "blueprint string, correlation_key string, event_type string, role string, event_ts timestamp, place string, status string"
    row = lambda k, s: ("state", k, "q", "request", s, "x", None)
    made = spark.createDataFrame([row("a", 1), row("a", 1), row("b", 2), row(" ", 2), row("c", None)], schema.replace("event_ts timestamp", "event_ts long"))
    made = made.withColumn("event_ts", F.timestamp_seconds(F.col("event_ts") + START))
    # The stored history is not read.
    monkeypatch.setattr(S, "read_batches", None)
    for _ in range(2):
        made.write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(schema).parquet(f"{root}/in")
        S.store_stream(arriving, BP, root, timedelta(hours=1), mode="batch").awaitTermination()
    stored = tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(BP)).collect()
    assert sorted(r.correlation_key for r in stored) == ["a", "b"]
    assert len({tuple(r.event_id) for r in stored}) == 2 and all(r.event_hash and r.payload for r in stored)


@pytest.mark.parametrize("salts", [1, 8])
def test_bucket_counts_of_a_hot_bucket(spark, tmp_path, salts):
    """Most pairs are in one bucket; the sub-states of a bucket add up."""
    root = str(tmp_path)
    pairs = spark.range(400).select(
        F.struct(F.lit(0).cast("long").alias("batch"), F.col("id").alias("row")).alias("pair_id"),
        F.timestamp_seconds(F.lit(START) + F.when(F.col("id") < 300, 5).otherwise(F.col("id"))).alias("response_ts"),
        (F.col("id") % 7).alias("latency_ms"),
        F.when(F.col("id") % 2 == 0, "SUCCESS").when(F.col("id") % 3 == 0, "ERROR").otherwise("UNKNOWN").alias("outcome"),
        F.lit(None).cast("string").alias("place"),
    )
    pairs.write.parquet(f"{root}/in")
    arriving = spark.readStream.schema(pairs.schema).parquet(f"{root}/in")
    with K.keyed_state(spark):
        counted = K.count_in_state(arriving, BP, timedelta(0), salts).writeStream.format("memory").queryName(f"counted_{salts}")
        counted.option("checkpointLocation", f"{root}/progress").trigger(availableNow=True).start().awaitTermination()
    sums = ("n", "success_count", "error_count")
    got = spark.table(f"counted_{salts}").groupBy("bucket_start", "latency_ms").agg(*[F.sum(c).alias(c) for c in sums])
    bucket = F.date_trunc("minute", "response_ts")
    expected = pairs.groupBy(bucket.alias("bucket_start"), "latency_ms").agg(
        F.count("*"), F.sum((F.col("outcome") == "SUCCESS").cast("int")), F.sum((F.col("outcome") == "ERROR").cast("int"))
    )
    last = pairs.agg(F.max("response_ts")).first()[0]
    closed = {tuple(r) for r in expected.collect() if r.bucket_start + timedelta(minutes=1) <= last}
    assert {tuple(r) for r in got.collect()} == closed and closed
