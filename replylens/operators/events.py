"""From parsed records to normalised events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replylens.blueprint import Blueprint, column_of
from replylens.functions import field, once, strict_instant
from replylens.operators import dedup

REQUEST = "request"
RESPONSE = "response"


def role(bp: Blueprint) -> Column:
    """`request`, `response` or NULL. Request and response may be told by different fields."""
    return F.when(field(bp.request_type_field) == bp.request_value, F.lit(REQUEST)).when(
        field(bp.response_type_field) == bp.response_value, F.lit(RESPONSE)
    )


def event_type(bp: Blueprint) -> Column:
    """The stored type: the request value if it applies, else the response type field."""
    asked = field(bp.request_type_field)
    return F.when(asked == bp.request_value, asked).otherwise(field(bp.response_type_field))


def event_time(df: DataFrame, name: str) -> Column:
    if isinstance(df.schema[name].dataType, T.StringType):
        return strict_instant(field(name))
    return field(name).cast("timestamp")


def classify(df: DataFrame, bp: Blueprint) -> DataFrame:
    """Add `role` and drop records that are neither request nor response."""
    return df.filter(has_role(bp)).withColumn("role", role(bp))


def has_role(bp: Blueprint) -> Column:
    """The same as `role(bp).isNotNull()`, as comparisons that reach the scan."""
    return (field(bp.request_type_field) == bp.request_value) | (
        field(bp.response_type_field) == bp.response_value
    )


def valid_events(df: DataFrame) -> DataFrame:
    """Drop events without a time or with a blank key. The key itself is not trimmed."""
    return df.filter(F.col("event_ts").isNotNull() & (F.trim(F.col("correlation_key")) != ""))


def require_core_fields(df: DataFrame, bp: Blueprint) -> DataFrame:
    """Keep records that have a key, a type and a timestamp text."""
    return df.filter(
        field(bp.key_field).isNotNull()
        & event_type(bp).isNotNull()
        & field(bp.timestamp_field).isNotNull()
    )


# Columns that say where a record came from, not what it holds.
TECHNICAL = ("event_id", "source", "offset", "value", "is_object", "fields")


def record_payload(df: DataFrame) -> Column:
    """The whole record as JSON text: the MAP column `fields` if there is one, else all columns of the record."""
    if "fields" in df.columns and isinstance(df.schema["fields"].dataType, T.MapType):
        return dedup.payload(F.col("fields"))
    return dedup.columns_payload([c for c in df.columns if c not in TECHNICAL])


def normalise(df: DataFrame, bp: Blueprint, keep: list | None = None, payload: bool = False) -> DataFrame:
    """Flat records -> events (blueprint, correlation_key, event_type, role, event_ts, carried fields).

    `role` stays NULL for other message types, which are stored but never matched. Only the
    fields the blueprint names are read; `keep` lists further columns to pass through, and `payload`
    adds the whole record as JSON text.
    """
    if keep is None:
        keep = [c for c in ("event_id", "source", "offset") if c in df.columns]
    records = require_core_fields(df, bp)
    time = event_time(df, bp.timestamp_field)
    if isinstance(df.schema[bp.timestamp_field].dataType, T.StringType):
        records, time = once(records, [time.alias("_time")]), F.col("_time")
    return records.select(
        *keep,
        F.lit(bp.name).alias("blueprint"),
        field(bp.key_field).cast("string").alias("correlation_key"),
        event_type(bp).alias("event_type"),
        role(bp).alias("role"),
        time.alias("event_ts"),
        *[field(c).cast("string").alias(column_of(c)) for c in bp.carried_fields],
        *([record_payload(df).alias("payload")] if payload else []),
    )


def matchable(df: DataFrame, bp: Blueprint) -> DataFrame:
    """Flat records -> valid, classified events, ready for `correlate`."""
    return valid_events(normalise(df.filter(has_role(bp)), bp))


def split_rejects(df: DataFrame, reason: Column, value: Column, source: Column | None = None) -> tuple:
    """(good, quarantine). `reason` is NULL for good rows; rejects keep their text and reason."""
    marked = df.withColumn("_reason", reason)
    good = marked.filter(F.col("_reason").isNull()).drop("_reason")
    bad = marked.filter(F.col("_reason").isNotNull()).select(
        (F.lit(None).cast("string") if source is None else source).alias("source"),
        value.alias("value"),
        F.col("_reason").alias("reason"),
    )
    return good, bad
