"""Arrival-order matching and the transaction table of the older report set.

It differs from `correlate` on purpose: messages are taken in arrival order, there is no
event-time timeout, the channel comes from the request, and latencies outside 1..60000 ms are
kept but flagged invalid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.functions import latency_ms
from replylens.operators import skew
from replylens.operators.correlate import HOT_ROWS, _match

# The valid latency range and the markers of unfinished transactions.
MIN_TAT, MAX_TAT = 1, 60_000
TIMEOUT_TAT, TIMEOUT_CODE = -1, "TIMEOUT"
NO_CHANNEL, NO_CODE = "UNKNOWN", "PENDING"
REQUEST_MTI, RESPONSE_MTI = "1200", "1210"
SUCCESS_CODE = "000"

TRANSACTION_COLUMNS = [
    "pair_id",
    "correlation_key",
    "stan",
    "pan",
    "channel",
    "tat_millis",
    "response_code",
    "is_valid",
    "completed_at",
]


def mti_filter(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("message_id").isin(REQUEST_MTI, RESPONSE_MTI))


def valid_tat(tat: Column) -> Column:
    return tat.between(MIN_TAT, MAX_TAT)


def status(tat: Column) -> Column:
    return F.when(tat >= 0, F.lit("COMPLETED")).otherwise(F.lit("TIMEOUT"))


def channel_or_default(channel: Column) -> Column:
    return F.coalesce(channel, F.lit(NO_CHANNEL))


def code_or_default(code: Column) -> Column:
    return F.coalesce(code, F.lit(NO_CODE))


def _arrival_pairs(events, arrival, hot_rows, per_segment) -> DataFrame:
    """(key, q, p) in arrival order; p is NULL for the request that a key still waits with."""
    position = F.col("event_id") if arrival is None else arrival
    return _match(events, position, ["stan", "pan", "channel", "response_code"], None, hot_rows, per_segment)


def _transactions(pairs: DataFrame, as_of: Column) -> DataFrame:
    answered = F.col("p").isNotNull()
    tat = latency_ms(F.col("q.body.ts"), F.col("p.body.ts"))

    def either(done, late):
        return F.when(answered, done).otherwise(late)

    return pairs.select(
        either(F.col("p.id"), F.col("q.id")).alias("pair_id"),
        "correlation_key",
        F.col("q.body.f0").alias("stan"),
        F.col("q.body.f1").alias("pan"),
        channel_or_default(F.col("q.body.f2")).alias("channel"),
        either(tat, F.lit(TIMEOUT_TAT).cast("bigint")).alias("tat_millis"),
        either(code_or_default(F.col("p.body.f3")), F.lit(TIMEOUT_CODE)).alias("response_code"),
        either(valid_tat(tat), F.lit(False)).alias("is_valid"),
        either(F.col("p.body.ts"), as_of).alias("completed_at"),
        F.col("q.id").alias("request_id"),
        F.col("p.id").alias("response_id"),
    )


def correlate_legacy(
    events: DataFrame,
    arrival: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
    per_segment: int = skew.ROWS_PER_SEGMENT,
) -> DataFrame:
    """Events (event_id, correlation_key, role, event_ts, stan, pan, channel, response_code) ->
    completed transactions, plus the ids of both messages."""
    pairs = _arrival_pairs(events, arrival, hot_rows, per_segment).filter(F.col("p").isNotNull())
    return _transactions(pairs, F.lit(None).cast("timestamp"))


def waiting_requests(
    events: DataFrame, arrival: Column | None = None, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """The request still waiting per key: the earliest arrival since the key's last response.

    A later request of the same key is shadowed by it and was never stored. Both steps are
    aggregates, so the rows of one key are combined before the shuffle.
    """
    events = events.withColumn("_at", F.col("event_id") if arrival is None else arrival)
    answered = events.filter(F.col("role") == "response")
    last = answered.groupBy("correlation_key").agg(F.max("_at").alias("last_response"))
    rest = [c for c in events.columns if c != "correlation_key"]
    asked = events.filter(F.col("role") == "request")
    after = skew.key_join(asked, last, "correlation_key", "left", hot_rows)
    after = after.filter(F.col("last_response").isNull() | (F.col("_at") > F.col("last_response")))
    return (
        after.groupBy("correlation_key")
        .agg(F.min_by(F.struct(*rest), F.col("_at")).alias("row"))
        .select("correlation_key", *[F.col(f"row.{c}").alias(c) for c in rest if c != "_at"])
    )


def timeout_transactions(waiting: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Waiting requests older than `minutes` at `as_of` as TIMEOUT transactions."""
    limit = F.lit(minutes * 60 * 1_000_000).cast("bigint")
    return waiting.filter(F.unix_micros(as_of) - F.unix_micros("event_ts") > limit).select(
        F.col("event_id").alias("pair_id"),
        "correlation_key",
        "stan",
        "pan",
        channel_or_default(F.col("channel")).alias("channel"),
        F.lit(TIMEOUT_TAT).cast("bigint").alias("tat_millis"),
        F.lit(TIMEOUT_CODE).alias("response_code"),
        F.lit(False).alias("is_valid"),
        as_of.alias("completed_at"),
    )


def transaction_table(
    events: DataFrame,
    as_of: Column,
    minutes: int,
    arrival: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
    per_segment: int = skew.ROWS_PER_SEGMENT,
) -> DataFrame:
    """Completed transactions and those timed out at `as_of`, from one pass over the events."""
    pairs = _arrival_pairs(events, arrival, hot_rows, per_segment)
    limit = F.lit(minutes * 60 * 1_000_000).cast("bigint")
    overdue = F.unix_micros(as_of) - F.unix_micros(F.col("q.body.ts")) > limit
    return _transactions(pairs.filter(F.col("p").isNotNull() | overdue), as_of).select(*TRANSACTION_COLUMNS)


def unexported_transactions(
    transactions: DataFrame,
    exported_keys: DataFrame,
    limit: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Completed rows whose key has a valid, not yet exported row. An invalid row that shares
    such a key comes along. `limit` bounds the valid rows taken per call, lowest id first.

    Keys are made distinct before the anti join, so it sees each key once.
    """
    key = "correlation_key"
    valid = transactions.filter("is_valid")
    keys = valid.select(key).distinct().join(exported_keys.select(key).distinct(), key, "left_anti")
    if limit is not None:
        chosen = skew.key_join(valid.select(key, "pair_id"), keys, key, "left_semi", hot_rows)
        keys = chosen.orderBy("pair_id").limit(limit).select(key).distinct()
    completed = transactions.filter(F.col("response_code") != TIMEOUT_CODE)
    return skew.key_join(completed, keys, key, "left_semi", hot_rows)


def exported_keys(transactions: DataFrame) -> DataFrame:
    """The ledger entry of an export: by key, so a key that comes back is never exported again."""
    return transactions.select("correlation_key").distinct()
