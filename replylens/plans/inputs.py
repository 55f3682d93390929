"""The given tables read as request/response logs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replylens.blueprint import Blueprint, Metric, MetricSource, MetricType
from replylens.operators import events as E

# The older report set flags latencies over a minute as invalid. The events of one user are
# hours apart, so their clock is read a thousand times faster there.
CLOCK_START_US = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z
CLOCK_RATE = 1000
AS_OF = "2024-01-01 00:45:00"
AT_MS = 1_704_069_900_000
TIMEOUT_MINUTES = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock UTC without a zone, so that they do not depend on the reader."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


CLICKS = Blueprint(
    name="clicks",
    key_field="user_id",
    request_type_field="event_type",
    response_type_field="event_type",
    request_value="view",
    response_value="purchase",
    timestamp_field="ts",
    dimensions=("channel",),
    granularity="1d",
    timeout=timedelta(hours=48),
    status_field="status",
    success_values={"000"},
    metrics=(
        Metric("latency", MetricType.HISTOGRAM),
        Metric("count", MetricType.COUNTER),
        Metric("errors", MetricType.COUNTER, MetricSource.ERROR_COUNT),
        Metric("successes", MetricType.COUNTER, MetricSource.SUCCESS_COUNT),
        Metric("latency.now", MetricType.GAUGE, MetricSource.LATENCY_MS),
        Metric("latency.avg", MetricType.GAUGE, MetricSource.AVG_LATENCY_MS),
        Metric("latency.min", MetricType.GAUGE, MetricSource.MIN_LATENCY_MS),
        Metric("latency.max", MetricType.GAUGE, MetricSource.MAX_LATENCY_MS),
        Metric("latency.p95", MetricType.GAUGE, MetricSource.P95_LATENCY_MS),
        Metric("latency.p99", MetricType.GAUGE, MetricSource.P99_LATENCY_MS),
        Metric("success_rate", MetricType.RATE, MetricSource.SUCCESS_RATE),
        Metric("error_rate", MetricType.RATE, MetricSource.ERROR_RATE),
        Metric("throughput", MetricType.RATE),
    ),
)

SHIPMENTS = Blueprint(
    name="shipments",
    key_field="orderkey",
    request_type_field="ask",
    response_type_field="reply",
    request_value="order",
    response_value="ship",
    timestamp_field="ts",
    dimensions=("priority", "returnflag"),
    granularity="1d",
    timeout=timedelta(days=365),
    status_field="linestatus",
    success_values={"F"},
)

TURNS = Blueprint(
    name="turns",
    key_field="conv_id",
    request_type_field="role",
    response_type_field="role",
    request_value="user",
    response_value="assistant",
    timestamp_field="ts",
    granularity="1h",
    timeout=timedelta(seconds=1),
)


def click_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        "ts",
        F.concat(F.lit("ch"), (F.col("user_id") % 5).cast("string")).alias("channel"),
        F.when(k % 4 == 0, F.lit("500")).otherwise(F.lit("000")).alias("status"),
    )


def end_of_input(records: DataFrame, bp: Blueprint, at_us: int) -> DataFrame:
    """One request of a key of its own, which moves a watermark past all other records."""
    named = {bp.key_field: F.lit("end of input"), bp.request_type_field: F.lit(bp.request_value), bp.timestamp_field: F.timestamp_micros(F.lit(at_us))}
    row = records.sparkSession.range(1)
    return row.select(*[named.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in records.schema.fields])


def click_events(spark: SparkSession, sf_dir: str, bp: Blueprint = CLICKS) -> DataFrame:
    return E.matchable(click_records(spark, sf_dir), bp)


def shipment_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders ask, line items reply; the two sides are told apart by different fields."""
    none = F.lit(None).cast("string")
    asks = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order-"), "o_orderkey").alias("event_id"),
        F.col("o_orderkey").cast("string").alias("orderkey"),
        F.lit("order").alias("ask"),
        none.alias("reply"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderpriority").alias("priority"),
        none.alias("returnflag"),
        none.alias("linestatus"),
    )
    lines = table(spark, sf_dir, "lineitem")
    # Line numbers repeat within an order, so part, supplier and day belong to the identity.
    day = F.date_format("l_shipdate", "yyyyMMdd")
    identity = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", day)
    replies = lines.select(
        identity.alias("event_id"),
        F.col("l_orderkey").cast("string").alias("orderkey"),
        none.alias("ask"),
        F.lit("ship").alias("reply"),
        F.col("l_shipdate").alias("ts"),
        none.alias("priority"),
        F.col("l_returnflag").alias("returnflag"),
        F.col("l_linestatus").alias("linestatus"),
    )
    return asks.unionByName(replies)


def turn_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 100_000 + F.col("turn")).alias("event_id"),
        F.col("conv_id").cast("string").alias("conv_id"),
        "role",
        F.timestamp_seconds(F.lit(1_704_067_200) + F.col("turn")).alias("ts"),
    )


def card_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as payment messages for the older report set.

    They arrive slightly out of order: `event_id` is the arrival number.
    """
    records = click_records(spark, sf_dir)
    late = (F.col("event_id") * 7919) % 23
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    fast = F.lit(CLOCK_START_US) + F.floor((micros - F.lit(CLOCK_START_US)) / CLOCK_RATE)
    message_id = (
        F.when(F.col("event_type") == "view", F.lit("1200"))
        .when(F.col("event_type") == "purchase", F.lit("1210"))
        .otherwise(F.lit("1804"))
    )
    pan = F.concat(F.lit("4000"), F.lpad("user_id", 8, "0"))
    return records.select(
        ((F.col("event_id") + late) * 1_000_000_000 + F.col("event_id")).alias("event_id"),
        F.concat_ws("|", pan, F.col("user_id")).alias("correlation_key"),
        message_id.alias("message_id"),
        F.when(message_id == "1200", F.lit(E.REQUEST)).when(message_id == "1210", F.lit(E.RESPONSE)).alias("role"),
        F.timestamp_micros(fast.cast("bigint")).alias("event_ts"),
        F.col("user_id").alias("stan"),
        pan.alias("pan"),
        "channel",
        F.when(message_id == "1210", F.col("status")).alias("response_code"),
    )
