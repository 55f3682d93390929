"""Identity of events and pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def payload(fields: Column) -> Column:
    """The record as a JSON object with its fields sorted by name."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(fields))))


def event_hash(record: Column) -> Column:
    """SHA-256 over blueprint, key, type, time and the record as `payload` writes it."""
    return F.sha2(
        F.concat_ws(
            "\n",
            F.col("blueprint"),
            F.col("correlation_key"),
            F.col("event_type"),
            F.unix_micros("event_ts").cast("string"),
            record,
        ),
        256,
    )


def columns_as_fields(names: list) -> Column:
    """MAP of the named columns, absent (NULL) ones left out."""
    pairs = [F.struct(F.lit(n).alias("key"), F.col(f"`{n}`").cast("string").alias("value")) for n in names]
    return F.map_from_entries(F.filter(F.array(*pairs), lambda e: e["value"].isNotNull()))


def columns_payload(names: list) -> Column:
    """`payload(columns_as_fields(names))`; the names are known here, so no row has to sort them."""
    if not names:
        return payload(columns_as_fields(names))
    fields = F.struct(*[F.col(f"`{n}`").cast("string").alias(n) for n in sorted(names)])
    return F.to_json(fields, {"ignoreNullFields": "true"})


def with_event_hash(events: DataFrame, record: Column) -> DataFrame:
    return events.withColumn("event_hash", event_hash(record))


def dedup_events(events: DataFrame, order: str = "event_id") -> DataFrame:
    """One row per identity (blueprint, event_hash): the one with the smallest `order`.

    Copies are equal in every other column, so those group, and the smallest `order` is found by a
    hash aggregate that combines copies before the shuffle.
    """
    rest = [c for c in events.columns if c != order]
    return events.groupBy(*rest).agg(F.min(order).alias(order)).select(*events.columns)


def dedup_pairs(pairs: DataFrame) -> DataFrame:
    """One row per (blueprint, key, request time, response time), smallest pair id kept."""
    identity = ["blueprint", "correlation_key", "request_ts", "response_ts"]
    rest = [c for c in pairs.columns if c not in identity]
    return (
        pairs.groupBy(*identity)
        .agg(F.min_by(F.struct(*rest), F.col("pair_id")).alias("row"))
        .select(*identity, *[F.col(f"row.{c}").alias(c) for c in rest])
        .select(*pairs.columns)
    )


def new_events(events: DataFrame, stored: DataFrame) -> DataFrame:
    """Events whose identity is not stored yet."""
    return events.join(stored.select("blueprint", "event_hash"), ["blueprint", "event_hash"], "left_anti")
