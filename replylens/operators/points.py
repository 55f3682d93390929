"""Bucket rows -> named metric data points and export documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replylens.blueprint import Blueprint, Metric, MetricSource, MetricType, column_of
from replylens.session import cut_lineage

PREFIX = "replylens."
SERVICE = "replylens"
DELTA = 1  # Fixed value: delta temporality in the metric document.
NANOS = 1_000_000_000
# Size of a packed document, and of the points that one task numbers.
MOST_BYTES, PART_BYTES = 1 << 20, 256 << 20

_COLUMN = {
    MetricSource.LATENCY_MS: "avg_latency_ms",
    MetricSource.COUNT: "count",
    MetricSource.SUCCESS_COUNT: "success_count",
    MetricSource.ERROR_COUNT: "error_count",
    MetricSource.AVG_LATENCY_MS: "avg_latency_ms",
    MetricSource.MIN_LATENCY_MS: "min_latency_ms",
    MetricSource.MAX_LATENCY_MS: "max_latency_ms",
    MetricSource.P95_LATENCY_MS: "p95_latency_ms",
    MetricSource.P99_LATENCY_MS: "p99_latency_ms",
    MetricSource.SUCCESS_RATE: "success_rate",
    MetricSource.ERROR_RATE: "error_rate",
    MetricSource.THROUGHPUT_PER_SECOND: "throughput",
}


def metric_name(name: str, prefix: str = PREFIX) -> str:
    return name if name.startswith(prefix) else prefix + name


def metric_names(name: Column, prefix: str = PREFIX) -> Column:
    return F.when(name.startswith(prefix), name).otherwise(F.concat(F.lit(prefix), name))


def start_nanos() -> Column:
    return F.unix_seconds("bucket_start") * F.lit(NANOS)


def end_nanos() -> Column:
    return start_nanos() + F.col("bucket_seconds") * F.lit(NANOS)


def attributes(bp: Blueprint) -> Column:
    """[{key, value}] of the dimensions that are present."""
    items = [
        F.struct(F.lit(d).alias("key"), F.col(column_of(d)).alias("value")) for d in bp.dimensions
    ]
    if not items:
        return F.from_json(F.lit("[]"), "array<struct<key:string,value:string>>")
    return F.filter(F.array(*items), lambda a: a["value"].isNotNull())


def _point(metric: Metric, prefix: str) -> Column:
    value = F.col(_COLUMN[metric.source])
    none_long, none_double = F.lit(None).cast("bigint"), F.lit(None).cast("double")
    histogram, counter = metric.type is MetricType.HISTOGRAM, metric.type is MetricType.COUNTER
    return F.struct(
        F.lit(metric_name(metric.name, prefix)).alias("metric"),
        F.lit(metric.type.value).alias("type"),
        (F.col("count") if histogram else none_long).alias("point_count"),
        (F.col("avg_latency_ms") * F.col("count") if histogram else none_double).alias("point_sum"),
        (value.cast("bigint") if counter else none_long).alias("as_int"),
        (none_double if histogram or counter else value.cast("double")).alias("as_double"),
    )


def metric_points(buckets: DataFrame, bp: Blueprint, prefix: str = PREFIX) -> DataFrame:
    """One row per bucket and blueprint metric. A histogram point has count and sum, a counter an
    integer, a gauge or rate a double."""
    every = F.array(*[_point(m, prefix) for m in bp.metrics])
    return buckets.select(
        start_nanos().alias("start_ns"),
        end_nanos().alias("end_ns"),
        *[F.col(d) for d in bp.dimension_columns],
        F.explode(every).alias("p"),
    ).select("start_ns", "end_ns", *bp.dimension_columns, "p.*")


def _document_point(metric: Metric, bp: Blueprint) -> Column:
    """JSON text of a bucket's point of a metric."""

    def text(c):
        return c.cast("string")

    string_value = F.transform(
        attributes(bp),
        lambda a: F.struct(a["key"].alias("key"), F.struct(a["value"].alias("stringValue")).alias("value")),
    )
    common = [
        text(start_nanos()).alias("startTimeUnixNano"),
        text(end_nanos()).alias("timeUnixNano"),
        string_value.alias("attributes"),
    ]
    value = F.col(_COLUMN[metric.source])
    if metric.type is MetricType.HISTOGRAM:
        own = [
            text(F.col("count")).alias("count"),
            (F.col("avg_latency_ms") * F.col("count")).alias("sum"),
            F.array(text(F.col("count"))).alias("bucketCounts"),
            F.array().cast("array<double>").alias("explicitBounds"),
        ]
    elif metric.type is MetricType.COUNTER:
        own = [text(value.cast("bigint")).alias("asInt")]
    else:
        own = [value.cast("double").alias("asDouble")]
    return F.to_json(F.struct(*common, *own))


# The form of a metric in a document, and what follows its points.
_FORMS = {
    MetricType.HISTOGRAM: ("histogram", f',"aggregationTemporality":{DELTA}'),
    MetricType.COUNTER: ("sum", f',"aggregationTemporality":{DELTA},"isMonotonic":true'),
    MetricType.GAUGE: ("gauge", ""),
    MetricType.RATE: ("gauge", ""),
}


def _document_metric(metric: Metric, points: Column, prefix: str) -> Column:
    """JSON text of a metric with `points`, JSON texts joined by commas."""
    kind, more = _FORMS[metric.type]
    name = json.dumps(metric_name(metric.name, prefix), ensure_ascii=False)
    return F.concat(F.lit(f'{{"name":{name},"{kind}":{{"dataPoints":['), points, F.lit(f"]{more}}}}}"))


def metric_documents(
    buckets: DataFrame, bp: Blueprint, prefix: str = PREFIX, service: str = SERVICE
) -> DataFrame:
    """One export document (resource -> scope -> metrics -> points) per bucket row.

    A document has as many metrics as the blueprint, so its size does not depend on the data
    and no rows have to be gathered.
    """
    metrics = F.concat_ws(",", *[_document_metric(m, _document_point(m, bp), prefix) for m in bp.metrics])
    return buckets.select("bucket_start", *bp.dimension_columns, _document(metrics, service).alias("document"))


def _document(metrics: Column, service: str) -> Column:
    name = F.to_json(F.struct(F.lit(service).alias("stringValue")))
    head = F.concat(
        F.lit('{"resourceMetrics":[{"resource":{"attributes":[{"key":"service.name","value":'),
        name,
        F.lit('}]},"scopeMetrics":[{"scope":'),
        F.to_json(F.struct(F.lit(service).alias("name"))),
        F.lit(',"metrics":['),
    )
    return F.concat(head, metrics, F.lit("]}]}]}"))


def packed_documents(
    buckets: DataFrame, bp: Blueprint, prefix: str = PREFIX, service: str = SERVICE, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """(part, pack, buckets, document): export documents of many buckets, each below `most_bytes`.

    Every metric of a document has the points of all its buckets, each point once. Buckets are spread over
    parts by a hash, numbered by running size inside a part, and a pack is closed at half of `most_bytes`,
    so that its last bucket fits. A bucket that needs more than that half by itself may exceed the limit.
    """
    keys = ["bucket_start", *bp.dimension_columns]
    texts = {f"p{i}": _document_point(m, bp) for i, m in enumerate(bp.metrics)}
    rows = buckets.select(*keys, *[text.alias(name) for name, text in texts.items()])
    rows = cut_lineage(rows.withColumn("bytes", F.octet_length(F.concat_ws(",", *texts)).cast("bigint")))
    parts = max(1, -(-(rows.agg(F.sum("bytes")).first()[0] or 0) // PART_BYTES))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("part")
    before = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("bytes").over(before), F.lit(0))
    packs = (
        rows.select("*", part)
        .withColumn("pack", F.floor(filled / F.lit(most_bytes // 2)))
        .groupBy("part", "pack")
        .agg(F.count(F.lit(1)).alias("buckets"), F.sort_array(F.collect_list(F.struct(*keys, *texts))).alias("rows"))
    )
    joined = [F.array_join(F.col("rows")[name], ",") for name in texts]
    metrics = F.concat_ws(",", *[_document_metric(m, points, prefix) for m, points in zip(bp.metrics, joined, strict=True)])
    return packs.select("part", "pack", "buckets", _document(metrics, service).alias("document"))


def timeout_points(transactions: DataFrame, granularity_seconds: int) -> DataFrame:
    """Timeouts and their percentage of all transactions per bucket and channel."""
    from replylens.functions import bucket_start

    timed_out = F.sum((F.col("response_code") == "TIMEOUT").cast("bigint"))
    return (
        transactions.groupBy(
            bucket_start(F.col("completed_at"), granularity_seconds).alias("bucket_start"), "channel"
        )
        .agg(timed_out.alias("timeouts"), F.count(F.lit(1)).alias("total"))
        .filter(F.col("timeouts") > 0)
        .select(
            "bucket_start",
            "channel",
            "timeouts",
            (F.col("timeouts") * 100.0 / F.col("total")).alias("percent"),
        )
    )
