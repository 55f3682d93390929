"""The blueprint: which fields of a log mean what, and what to measure."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import timedelta
from enum import Enum

_UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400}

# Column names the engine itself writes; a dimension may not reuse them.
RESERVED = frozenset(
    "blueprint event_id event_hash event_ts event_type role correlation_key pair_id request_id "
    "response_id request_ts response_ts latency_ms outcome bucket_start bucket_seconds count "
    "success_count error_count min_latency_ms max_latency_ms avg_latency_ms p95_latency_ms "
    "p99_latency_ms success_rate error_rate throughput source fields".split()
)


class MetricType(Enum):
    HISTOGRAM = "HISTOGRAM"
    COUNTER = "COUNTER"
    GAUGE = "GAUGE"
    RATE = "RATE"


class MetricSource(Enum):
    LATENCY_MS = "LATENCY_MS"
    COUNT = "COUNT"
    SUCCESS_COUNT = "SUCCESS_COUNT"
    ERROR_COUNT = "ERROR_COUNT"
    AVG_LATENCY_MS = "AVG_LATENCY_MS"
    MIN_LATENCY_MS = "MIN_LATENCY_MS"
    MAX_LATENCY_MS = "MAX_LATENCY_MS"
    P95_LATENCY_MS = "P95_LATENCY_MS"
    P99_LATENCY_MS = "P99_LATENCY_MS"
    SUCCESS_RATE = "SUCCESS_RATE"
    ERROR_RATE = "ERROR_RATE"
    THROUGHPUT_PER_SECOND = "THROUGHPUT_PER_SECOND"


_COUNTS = {MetricSource.COUNT, MetricSource.SUCCESS_COUNT, MetricSource.ERROR_COUNT}
_RATES = {MetricSource.SUCCESS_RATE, MetricSource.ERROR_RATE, MetricSource.THROUGHPUT_PER_SECOND}

ALLOWED_SOURCES = {
    MetricType.HISTOGRAM: {MetricSource.LATENCY_MS},
    MetricType.COUNTER: _COUNTS,
    MetricType.RATE: _RATES,
    # A gauge over a count has no defined value, so it is refused when it is declared.
    MetricType.GAUGE: set(MetricSource) - _COUNTS,
}

DEFAULT_SOURCE = {
    MetricType.HISTOGRAM: MetricSource.LATENCY_MS,
    MetricType.COUNTER: MetricSource.COUNT,
    MetricType.RATE: MetricSource.THROUGHPUT_PER_SECOND,
    MetricType.GAUGE: MetricSource.AVG_LATENCY_MS,
}


def _text(value, label):
    if value is None or not str(value).strip():
        raise ValueError(f"{label} is required")
    return str(value).strip()


@dataclass(frozen=True)
class Metric:
    name: str
    type: MetricType
    source: MetricSource | None = None

    def __post_init__(self):
        object.__setattr__(self, "name", _text(self.name, "metric name"))
        kind = MetricType(self.type)
        source = DEFAULT_SOURCE[kind] if self.source is None else MetricSource(self.source)
        object.__setattr__(self, "type", kind)
        object.__setattr__(self, "source", source)
        if source not in ALLOWED_SOURCES[kind]:
            raise ValueError(f"a {kind.value} metric cannot use source {source.value}")


DEFAULT_METRICS = (
    Metric("event.latency", MetricType.HISTOGRAM),
    Metric("event.count", MetricType.COUNTER),
    Metric("event.throughput_per_second", MetricType.RATE),
)


def column_of(field_name: str) -> str:
    """Event column of a record field: nested fields such as `meta.region` lose the dot."""
    return field_name.replace(".", "_")


def granularity_seconds(granularity: str) -> int:
    """`30s`, `1m`, `2h`, `1d` -> seconds."""
    match = re.fullmatch(r"([0-9]+)(s|m|h|d)", granularity)
    if not match or int(match.group(1)) <= 0:
        raise ValueError("granularity must be a positive number followed by s, m, h or d")
    return int(match.group(1)) * _UNIT_SECONDS[match.group(2)]


@dataclass(frozen=True)
class Blueprint:
    name: str
    key_field: str
    request_type_field: str
    response_type_field: str
    request_value: str
    response_value: str
    timestamp_field: str
    dimensions: tuple = ()
    granularity: str = "1m"
    timeout: timedelta = timedelta(minutes=60)
    status_field: str | None = None
    success_values: frozenset = frozenset()
    metrics: tuple = field(default=())

    def __post_init__(self):
        for attr in (
            "name",
            "key_field",
            "request_type_field",
            "response_type_field",
            "request_value",
            "response_value",
            "timestamp_field",
            "granularity",
        ):
            object.__setattr__(self, attr, _text(getattr(self, attr), attr.replace("_", " ")))
        object.__setattr__(self, "dimensions", tuple(self.dimensions or ()))
        object.__setattr__(self, "success_values", frozenset(self.success_values or ()))
        object.__setattr__(self, "metrics", tuple(self.metrics or ()) or DEFAULT_METRICS)
        if self.timeout is None or self.timeout <= timedelta(0):
            raise ValueError("timeout must be positive")
        granularity_seconds(self.granularity)
        columns = [column_of(c) for c in self.carried_fields]
        clash = RESERVED.intersection(columns)
        if clash or len(set(columns)) != len(columns):
            raise ValueError(f"dimension or status names are reserved or ambiguous: {columns}")

    @property
    def bucket_seconds(self) -> int:
        return granularity_seconds(self.granularity)

    @property
    def timeout_us(self) -> int:
        return self.timeout // timedelta(microseconds=1)

    @property
    def carried_fields(self) -> list:
        """Columns an event must keep beside its key, role, time and id."""
        extra = [self.status_field] if self.status_field else []
        return list(dict.fromkeys([*self.dimensions, *extra]))

    @property
    def dimension_columns(self) -> list:
        return [column_of(c) for c in self.dimensions]

    @property
    def carried_columns(self) -> list:
        return [column_of(c) for c in self.carried_fields]

    @property
    def source_fields(self) -> list:
        """Every field the engine reads from a parsed record."""
        return list(
            dict.fromkeys(
                [
                    self.key_field,
                    self.request_type_field,
                    self.response_type_field,
                    self.timestamp_field,
                    *self.carried_fields,
                ]
            )
        )


def payment_blueprint(**overrides) -> Blueprint:
    """The built-in blueprint for payment message blocks."""
    settings = dict(
        name="iso8583-tat",
        key_field="correlation_key",
        request_type_field="direction",
        response_type_field="direction",
        request_value="REQ",
        response_value="RESP",
        timestamp_field="timestamp",
        dimensions=("channel", "response_code"),
        status_field="response_code",
        success_values={"000"},
        metrics=(
            Metric("transaction.latency", MetricType.HISTOGRAM),
            Metric("transaction.count", MetricType.COUNTER),
            Metric("transaction.success_count", MetricType.COUNTER, MetricSource.SUCCESS_COUNT),
            Metric("transaction.error_count", MetricType.COUNTER, MetricSource.ERROR_COUNT),
            Metric("transaction.latency.p95", MetricType.GAUGE, MetricSource.P95_LATENCY_MS),
            Metric("transaction.latency.p99", MetricType.GAUGE, MetricSource.P99_LATENCY_MS),
            Metric("transaction.success_rate", MetricType.RATE, MetricSource.SUCCESS_RATE),
            Metric("transaction.error_rate", MetricType.RATE, MetricSource.ERROR_RATE),
            Metric("transaction.throughput_per_second", MetricType.RATE),
        ),
    )
    settings.update(overrides)
    return Blueprint(**settings)
