"""Matching and counting in Spark's own streaming state, with timers on the watermark.

Both processors get their rows without the watermark column, so Spark drops none as late: a row that is
behind the watermark is told by the watermark itself and comes out at once, marked `late`. State lies in
the checkpoint, one store per shuffle partition; a restart goes on from there.

A key is handled by one task at a time. For matching that is inherent, because a key's events are one
sequence: keys known to be hot are left to the carry-over tables of `streaming.tail`, whose batch matching
splits them. Counting is salted instead, since counts add up.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from replylens.blueprint import Blueprint
from replylens.operators.correlate import KEY, pair_rows
from replylens.operators.events import REQUEST, RESPONSE
from replylens.sources.tables import batch_ids, read_batches, write_batch

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAIR, EXPIRED, SHADOWED, ORPHAN, LATE = "pair", "expired", "shadowed", "orphan", "late"
SALTS = 8


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which timers and list state need."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def interval(span: timedelta) -> str:
    return f"{span // timedelta(microseconds=1)} microseconds"


def up_to_ms(us: int) -> int:
    return -(-us // 1000)


# -- matching -------------------------------------------------------------------------------


class KeyedMatcher(StatefulProcessor):
    """One key: events wait until the watermark has passed them, then meet in time order.

    The rule is that of `operators.correlate`: a request waits if none is waiting, a waiting one older than
    the timeout is given up when the next event comes, a response takes the waiting request. A timer also
    gives up a request when the watermark has passed its timeout, so no later event is needed for that.
    """

    def __init__(self, body: str, timeout_us: int):
        self.body, self.timeout_us = body, timeout_us

    def init(self, handle) -> None:
        self.handle = handle
        self.arrived = handle.getListState("arrived", self.body)
        self.waiting = handle.getValueState("waiting", self.body)

    def handleInputRows(self, key, rows, timerValues):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        fresh = []
        for row in rows:
            if row.us <= watermark:
                yield Row(kind=LATE, correlation_key=key[0], q=None, p=tuple(row)[1:])
            else:
                fresh.append(tuple(row)[1:])
        if fresh:
            self.arrived.appendList(fresh)
            self.handle.registerTimer(up_to_ms(min(r[0] for r in fresh)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = tuple(self.waiting.get()) if self.waiting.exists() else None
        given_up = []
        events = [tuple(r) for r in self.arrived.get()] if self.arrived.exists() else []
        ready = sorted((r for r in events if r[0] <= watermark), key=lambda r: r[:3])
        rest = [r for r in events if r[0] > watermark]

        def out(kind, q=None, p=None):
            return Row(kind=kind, correlation_key=key[0], q=q, p=p)

        for event in ready:
            if waiting and event[0] - waiting[0] > self.timeout_us:
                given_up.append(out(EXPIRED, waiting))
                waiting = None
            if event[1] == 0:
                if waiting:
                    given_up.append(out(SHADOWED, event))
                else:
                    waiting = event
            elif waiting:
                yield out(PAIR, waiting, event)
                waiting = None
            else:
                yield out(ORPHAN, None, event)
        # Whatever comes is later than the watermark.
        if waiting and watermark - waiting[0] >= self.timeout_us:
            given_up.append(out(EXPIRED, waiting))
            waiting = None
        yield from given_up
        if rest:
            self.arrived.put(rest)
            self.handle.registerTimer(up_to_ms(min(r[0] for r in rest)))
        elif events:
            self.arrived.clear()
        if waiting:
            self.waiting.update(waiting)
            self.handle.registerTimer(up_to_ms(waiting[0] + self.timeout_us))
        elif self.waiting.exists():
            self.waiting.clear()

    def close(self) -> None:
        pass


def _body(events: DataFrame, bp: Blueprint) -> str:
    carried = "".join(f", f{i}: string" for i in range(len(bp.carried_columns)))
    return f"us: bigint, ord: int, id: {events.schema['event_id'].dataType.simpleString()}{carried}"


def matched_schema(body: str) -> str:
    side = f"struct<{body.replace(': ', ':')}>"
    return f"kind string, {KEY} string, q {side}, p {side}"


def match_in_state(events: DataFrame, bp: Blueprint, lateness: timedelta) -> DataFrame:
    """Streaming events (see `correlate`) -> (kind, correlation_key, q, p).

    `pair` has both sides; `expired` and `shadowed` requests (given up; another one was waiting) have q, an
    `orphan` response p, and so has a `late` event, which came more than `lateness` behind the newest one.
    """
    body = _body(events, bp)
    rows = (
        events.filter(F.col("role").isin(REQUEST, RESPONSE))
        .withWatermark("event_ts", interval(lateness))
        .select(
            KEY,
            F.unix_micros("event_ts").alias("us"),
            F.when(F.col("role") == REQUEST, 0).otherwise(1).alias("ord"),
            F.col("event_id").alias("id"),
            *[F.col(c).alias(f"f{i}") for i, c in enumerate(bp.carried_columns)],
        )
    )
    return rows.groupBy(KEY).transformWithState(
        KeyedMatcher(body.replace(": ", " "), bp.timeout_us), matched_schema(body), "append", "eventTime"
    )


def matched_pairs(rows: DataFrame, bp: Blueprint, empty_as_null: bool = False) -> DataFrame:
    """The pairs among the rows of `match_in_state`, as `correlate` gives them."""

    def side(name):
        fields = [F.col(f"{name}.f{i}").alias(f"f{i}") for i in range(len(bp.carried_columns))]
        ts = F.timestamp_micros(f"{name}.us").alias("ts")
        return F.struct(F.col(f"{name}.id").alias("id"), F.struct(ts, *fields).alias("body")).alias(name)

    return pair_rows(rows.filter(F.col("kind") == PAIR).select(KEY, side("q"), side("p")), bp, empty_as_null)


def given_up(rows: DataFrame, kinds: tuple = (EXPIRED, SHADOWED)) -> DataFrame:
    """(kind, correlation_key, event_id, event_ts) of the events that no pair has."""
    event = F.coalesce("q", "p")
    return rows.filter(F.col("kind").isin(*kinds)).select(
        "kind", KEY, event["id"].alias("event_id"), F.timestamp_micros(event["us"]).alias("event_ts")
    )


def tail_in_state(events: DataFrame, bp: Blueprint, root: str, lateness: timedelta, mode: str = "tail", poll_ms: int = 1000):
    """Start matching of streaming `events` in keyed state; rows go to <root>/matched, one batch each.

    In `batch` mode the run takes what is there and ends; events within `lateness` of the newest one stay in
    the state for the next run. A batch that is repeated after a failure replaces itself.
    """
    from replylens.streaming.tail import triggered

    def keep(rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{root}/matched", batch_id)

    with keyed_state(events.sparkSession):
        writer = match_in_state(events, bp, lateness).writeStream.foreachBatch(keep)
        return triggered(writer.option("checkpointLocation", f"{root}/_progress/state"), mode, poll_ms).start()


def stored_matches(spark: SparkSession, events: DataFrame, bp: Blueprint, root: str) -> DataFrame:
    return read_batches(spark, f"{root}/matched", matched_schema(_body(events, bp)))


# -- counting in buckets ----------------------------------------------------------------------


class BucketCounter(StatefulProcessor):
    """One (bucket, dimensions, salt): counts per latency until the watermark passes the bucket's end.

    What comes for a bucket that is closed already goes out at once, marked late.
    """

    COUNTS = "latency_ms bigint, n bigint, success_count bigint, error_count bigint"

    def __init__(self, bucket_us: int, names: list):
        self.bucket_us, self.names = bucket_us, names

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getListState("counts", self.COUNTS)

    def rows(self, key, counts, late: bool):
        sums: dict[int, list[int]] = {}
        for latency, *figures in counts:
            held = sums.setdefault(latency, [0, 0, 0])
            for i, figure in enumerate(figures):
                held[i] += figure
        names = self.names
        made = (Row(**dict(zip(names, (*tuple(key)[:-1], k, *figures, late), strict=True))) for k, figures in sums.items())
        return sums, made

    def handleInputRows(self, key, rows, timerValues):
        end = key[0] + self.bucket_us
        late = end <= timerValues.getCurrentWatermarkInMs() * 1000
        taken = [(r.latency_ms, 1, int(r.outcome == "SUCCESS"), int(r.outcome == "ERROR")) for r in rows]
        sums, made = self.rows(key, taken, late)
        if late:
            yield from made
        else:
            self.counts.appendList([(latency, *figures) for latency, figures in sums.items()])
            self.handle.registerTimer(up_to_ms(end))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self.rows(key, (tuple(r) for r in self.counts.get()), False)[1]
        self.counts.clear()

    def close(self) -> None:
        pass


def count_in_state(pairs: DataFrame, bp: Blueprint, lateness: timedelta, salts: int = SALTS) -> DataFrame:
    """Streaming pairs -> counts per (bucket, dimensions, latency, late) of the buckets that are closed.

    Rows without a pair_id only move the watermark. `salts` sub-states share a bucket, so one that holds
    most pairs is no single task; all of them close in the same micro-batch.
    """
    bucket_us = bp.bucket_seconds * 1_000_000
    us = F.unix_micros("response_ts")
    # The condition names the time, so that it is not pushed below the watermark, which all rows move.
    real = F.when(F.col("response_ts").isNotNull(), F.col("pair_id").isNotNull() & (F.col("latency_ms") >= 0))
    timed = (
        pairs.withWatermark("response_ts", interval(lateness))
        .filter(F.coalesce(real, F.lit(False)))
        .select(
            (us - F.pmod(us, F.lit(bucket_us))).alias("bucket_us"),
            *bp.dimension_columns,
            F.pmod(F.xxhash64("pair_id"), F.lit(salts)).alias("salt"),
            "latency_ms",
            "outcome",
        )
    )
    names = ["bucket_us", *bp.dimension_columns, "latency_ms", "n", "success_count", "error_count", "late"]
    dims = "".join(f"`{c}` string, " for c in bp.dimension_columns)
    counts = timed.groupBy("bucket_us", *bp.dimension_columns, "salt").transformWithState(
        BucketCounter(bucket_us, names), f"bucket_us bigint, {dims}{BucketCounter.COUNTS}, late boolean", "append", "eventTime"
    )
    return counts.select(F.timestamp_micros("bucket_us").alias("bucket_start"), *names[1:])
