import random
from datetime import timedelta

import pytest
from automaton import match
from pyspark.sql import functions as F

from replylens import Blueprint
from replylens.operators.correlate import _match, correlate, correlate_passes, orphan_responses, unmatched_requests

BP = Blueprint(
    name="t",
    key_field="key",
    request_type_field="kind",
    response_type_field="kind",
    request_value="begin",
    response_value="finish",
    timestamp_field="ts",
    timeout=timedelta(microseconds=20),
)


def events_df(spark, rows):
    df = spark.createDataFrame(
        [(k, us, o, i) for k, us, o, i in rows], "correlation_key string, us long, ord int, event_id long"
    )
    return df.select(
        "event_id",
        "correlation_key",
        F.when(F.col("ord") == 0, "request").when(F.col("ord") == 1, "response").alias("role"),
        F.timestamp_micros("us").alias("event_ts"),
    )


def random_rows(seed, n, keys, span, answers=0.4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.choices([0, 1, 2], [1 - answers, answers, 0.1])[0]
        rows.append((f"k{rng.randrange(keys)}", rng.randrange(span), kind, i))
    return rows


def ids(pairs):
    return {(r[0], r[1], r[2]) for r in pairs.select("correlation_key", "request_id", "response_id").collect()}


CASES = [
    (1, 800, 6, 900, 0.4),  # ties and short runs
    (2, 600, 2, 5000, 0.05),  # long request-only stretches
    (3, 500, 1, 120, 0.03),  # very dense storms
    (4, 700, 40, 3000, 0.5),
    (5, 900, 1, 20000, 0.02),  # chains of many replacements
]


@pytest.mark.parametrize("seed,n,keys,span,answers", CASES)
@pytest.mark.parametrize("hot", [None, 0, 150])
def test_equals_event_loop(spark, seed, n, keys, span, answers, hot):
    rows = random_rows(seed, n, keys, span, answers)
    expected = match([r for r in rows if r[2] < 2], 20)
    got = ids(correlate(events_df(spark, rows), BP, hot_rows=hot, per_segment=37))
    assert got == expected


@pytest.mark.parametrize("hot", [None, 0])
def test_without_timeout(spark, hot):
    rows = random_rows(9, 600, 3, 800)
    expected = match([r for r in rows if r[2] < 2], None)
    got = _match(events_df(spark, rows), F.unix_micros("event_ts"), [], None, hot, 50).cache()
    waiting = {r["correlation_key"] for r in got.filter("p IS NULL").collect()}
    last = {}
    for key, us, kind, id_ in sorted((r for r in rows if r[2] < 2), key=lambda r: r[1:]):
        last[key] = kind
    assert waiting == {k for k, kind in last.items() if kind == 0}
    got = got.filter("p IS NOT NULL")
    assert {(r[0], r[1], r[2]) for r in got.select("correlation_key", "q.id", "p.id").collect()} == expected


@pytest.mark.parametrize("hot", [None, 0])
def test_timeout_border_and_retry_chain(spark, hot):
    rows = [("eq", 0, 0, 1), ("eq", 20, 1, 2), ("over", 0, 0, 3), ("over", 21, 1, 4)]
    rows += [("r", 0, 0, 5), ("r", 10, 0, 6), ("r", 25, 0, 7), ("r", 30, 1, 8)]
    rows += [("zero", 7, 1, 9), ("zero", 7, 0, 10)]
    assert ids(correlate(events_df(spark, rows), BP, hot_rows=hot, per_segment=2)) == {
        ("eq", 1, 2),
        ("r", 7, 8),
        ("zero", 10, 9),
    }


def test_passes_and_leftovers(spark):
    rows = [("k", 1, 0, 1), ("k", 2, 0, 2), ("k", 3, 1, 3), ("k", 4, 1, 4), ("x", 1, 1, 5)]
    events = events_df(spark, rows)
    once = correlate(events, BP)
    assert ids(once) == {("k", 1, 3)}
    assert [r.event_id for r in unmatched_requests(events, once).collect()] == [2]
    assert {r.event_id for r in orphan_responses(events, once).collect()} == {4, 5}
    assert ids(correlate_passes(events, BP, 2)) == {("k", 1, 3), ("k", 2, 4)}
    assert ids(correlate_passes(events, BP, None)) == {("k", 1, 3), ("k", 2, 4)}


def test_many_copies_at_one_instant(spark):
    rows = [("k", 5, 0, i) for i in range(300)] + [("k", 5, 1, 1000 + i) for i in range(300)]
    got = ids(correlate(events_df(spark, rows), BP, hot_rows=0, per_segment=10))
    assert got == {("k", 0, 1000)}


def test_empty(spark):
    assert correlate(events_df(spark, [("k", 1, 0, 1)]).limit(0), BP).collect() == []


def test_single_exchange(spark):
    plan = correlate(events_df(spark, [("k", 1, 0, 1)]), BP, hot_rows=None)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


def test_source_is_evaluated_once(spark):
    """At its defaults `correlate` counts events per key and matches them, from one evaluation."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    events = spark.sql(
        """SELECT CAST(id AS BIGINT) event_id, CAST(id DIV 2 AS STRING) correlation_key, IF(id % 2 = 0, 'request', 'response') role,
        timestamp_seconds(id) event_ts, 'x' channel, '000' status FROM range(1000)"""
    )
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in events.schema)
    from replylens.plans.inputs import CLICKS

    assert correlate(events.mapInArrow(counted, columns), CLICKS).count() == 500
    assert seen.value == 1000
