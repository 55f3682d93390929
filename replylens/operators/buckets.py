"""Latency metrics per time bucket and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.blueprint import Blueprint
from replylens.functions import bucket_start, safe_ratio
from replylens.operators import quantiles as Q


def bucket_time(pairs: DataFrame, bp: Blueprint) -> DataFrame:
    """Response time, else the response's own field, else the request's; else dropped.

    `response_time` and `request_time` are optional fallback columns of the pair.
    """
    fallbacks = [F.col(c) for c in ("response_ts", "response_time", "request_time") if c in pairs.columns]
    ts = F.coalesce(*fallbacks)
    return pairs.filter(ts.isNotNull() & (F.col("latency_ms") >= 0)).withColumn(
        "bucket_start", bucket_start(ts, bp.bucket_seconds)
    )


def latency_counts(pairs: DataFrame, groups: list) -> DataFrame:
    return Q.value_counts(
        pairs,
        groups,
        "latency_ms",
        {
            "success_count": (F.col("outcome") == "SUCCESS").cast("int"),
            "error_count": (F.col("outcome") == "ERROR").cast("int"),
        },
    )


def finish_buckets(summary: DataFrame, groups: list, bp: Blueprint) -> DataFrame:
    classified = F.col("success_count") + F.col("error_count")
    return summary.select(
        F.col("bucket_start"),
        F.lit(bp.bucket_seconds).cast("bigint").alias("bucket_seconds"),
        *[F.col(g) for g in groups if g != "bucket_start"],
        F.col("n").alias("count"),
        "success_count",
        "error_count",
        F.col("low").alias("min_latency_ms"),
        F.col("high").alias("max_latency_ms"),
        (F.col("total").cast("double") / F.col("n")).alias("avg_latency_ms"),
        "p95_latency_ms",
        "p99_latency_ms",
        safe_ratio(F.col("success_count"), classified).alias("success_rate"),
        safe_ratio(F.col("error_count"), classified).alias("error_rate"),
        (F.col("n").cast("double") / F.lit(float(bp.bucket_seconds))).alias("throughput"),
    )


def buckets_from_counts(counts: DataFrame, groups: list, bp: Blueprint, **options) -> DataFrame:
    """Bucket rows from `latency_counts`; latencies lie in [0, timeout], which bounds a group."""
    summary = Q.summarise(
        counts,
        groups,
        "latency_ms",
        {"p95_latency_ms": Q.nearest_rank(0.95), "p99_latency_ms": Q.nearest_rank(0.99)},
        ["success_count", "error_count"],
        max_values=bp.timeout_us // 1000 + 1,
        **options,
    )
    return finish_buckets(summary, groups, bp)


def bucket_metrics(pairs: DataFrame, bp: Blueprint, per: list | None = None, **options) -> DataFrame:
    """Count, outcome, latency and throughput figures per (bucket, dimensions).

    `per` adds grouping columns, such as an export batch (one delta per batch) or a source.
    """
    groups = ["bucket_start", *(per or []), *bp.dimension_columns]
    timed = bucket_time(pairs, bp)
    return buckets_from_counts(latency_counts(timed, groups), groups, bp, **options)


def approximate_bucket_metrics(pairs: DataFrame, bp: Blueprint, accuracy: int = 10_000) -> DataFrame:
    """As `bucket_metrics` in one exchange, with percentiles within 1 / accuracy of the rank."""
    groups = ["bucket_start", *bp.dimension_columns]

    def near(q):
        return F.percentile_approx("latency_ms", q, accuracy)

    summary = (
        bucket_time(pairs, bp)
        .groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("latency_ms").alias("total"),
            F.min("latency_ms").alias("low"),
            F.max("latency_ms").alias("high"),
            F.sum((F.col("outcome") == "SUCCESS").cast("bigint")).alias("success_count"),
            F.sum((F.col("outcome") == "ERROR").cast("bigint")).alias("error_count"),
            near(0.95).alias("p95_latency_ms"),
            near(0.99).alias("p99_latency_ms"),
        )
    )
    return finish_buckets(summary, groups, bp)
