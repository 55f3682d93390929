"""Reports and analysis queries over the transaction table and over bucket rows.

Groups are channels, codes, time buckets or nothing at all, so one group may hold most of the
rows. Every report therefore aggregates with map-side combine; percentiles go through value
counts (see `quantiles`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.functions import bucket_start, mask_pan, round_half_up
from replylens.operators import quantiles as Q
from replylens.operators.legacy import SUCCESS_CODE, TIMEOUT_CODE, TIMEOUT_TAT

# The metric names of the older report set.
TRANSACTION_METRIC = "payment.transaction.tat"
CHANNEL_METRIC = "payment.channel.tat"
CODE_METRIC = "payment.response_code.tat"
SUCCESS_METRIC = "payment.success.rate"


def _gauge(name: str) -> list:
    return [F.lit(name).alias("metric_name"), F.lit("gauge").alias("metric_type")]


def _success() -> Column:
    return (F.col("response_code") == SUCCESS_CODE).cast("bigint")


def _timed_out() -> Column:
    return (F.col("response_code") == TIMEOUT_CODE).cast("bigint")


def _mean() -> Column:
    return F.col("total").cast("double") / F.col("n")


def _spread(transactions: DataFrame, groups: list, ranks: dict, weights: dict | None = None) -> DataFrame:
    counts = Q.value_counts(transactions, groups, "tat_millis", weights)
    return Q.summarise(counts, groups, "tat_millis", ranks, list(weights or {}))


# -- the four-section report -------------------------------------------------------------


def transaction_metrics(transactions: DataFrame, at_ms: Column) -> DataFrame:
    """One gauge row per transaction, card number masked."""
    return transactions.select(
        *_gauge(TRANSACTION_METRIC),
        F.col("tat_millis").alias("value"),
        F.lit("milliseconds").alias("unit"),
        F.col("stan").alias("transaction_id"),
        "channel",
        "response_code",
        mask_pan(F.col("pan")).alias("pan_masked"),
        at_ms.alias("timestamp_ms"),
    )


def channel_metrics(transactions: DataFrame, at_ms: Column) -> DataFrame:
    """One gauge row per channel."""
    sums = transactions.groupBy("channel").agg(
        F.count(F.lit(1)).alias("count"),
        F.sum("tat_millis").alias("sum_ms"),
        (F.sum("tat_millis").cast("double") / F.count(F.lit(1))).alias("avg_ms"),
        F.min("tat_millis").cast("double").alias("min_ms"),
        F.max("tat_millis").cast("double").alias("max_ms"),
    )
    return sums.select(*_gauge(CHANNEL_METRIC), "*", at_ms.alias("timestamp_ms"))


def response_code_metrics(transactions: DataFrame, at_ms: Column) -> DataFrame:
    ranks = {"p95": Q.floor_index(95), "p99": Q.floor_index(99)}
    return _spread(transactions, ["response_code"], ranks).select(
        *_gauge(CODE_METRIC),
        "response_code",
        F.col("n").alias("count"),
        _mean().alias("avg_ms"),
        F.col("low").cast("double").alias("min_ms"),
        F.col("high").cast("double").alias("max_ms"),
        F.coalesce(F.col("p95"), F.lit(-1)).cast("double").alias("p95_ms"),
        F.coalesce(F.col("p99"), F.lit(-1)).cast("double").alias("p99_ms"),
        at_ms.alias("timestamp_ms"),
    )


def summary_stats(transactions: DataFrame, at_ms: Column) -> DataFrame:
    """One row over all transactions; the success percentage counts every row."""
    ranks = {f"p{p}": Q.floor_index(p) for p in (50, 95, 99)}
    return (
        _spread(transactions, [], ranks, {"successes": _success()})
        .filter(F.col("n") > 0)
        .select(
            F.col("n").alias("total_transactions"),
            _mean().alias("avg_tat_ms"),
            F.col("low").cast("double").alias("min_tat_ms"),
            F.col("high").cast("double").alias("max_tat_ms"),
            *[F.coalesce(F.col(p), F.lit(-1)).cast("double").alias(f"{p}_ms") for p in ranks],
            F.col("successes").alias("success_count"),
            (F.col("successes").cast("double") * 100 / F.col("n")).alias("success_rate_pct"),
            at_ms.alias("timestamp_ms"),
        )
    )


# -- series ------------------------------------------------------------------------------


def channel_series(transactions: DataFrame, at_ms: Column) -> DataFrame:
    """(series_id, channel, response_code, timestamp_ms, value): a point of four series per channel
    and of the overall success percentage, rounded half up."""
    # One pass gives the rows per channel and the row over all of them.
    sums = transactions.cube("channel").agg(
        F.grouping("channel").alias("overall"),
        F.sum("tat_millis").alias("total"),
        F.min("tat_millis").alias("low"),
        F.max("tat_millis").alias("high"),
        F.sum(_success()).alias("ok"),
        F.count(F.lit(1)).alias("n"),
    )

    def series(name, value):
        return F.struct(F.lit(name).alias("series_id"), value.cast("double").alias("value"))

    percent = F.col("ok").cast("double") / F.col("n") * 100
    each = F.array(
        series(CHANNEL_METRIC + ".avg", round_half_up(_mean())),
        series(CHANNEL_METRIC + ".min", F.col("low")),
        series(CHANNEL_METRIC + ".max", F.col("high")),
        series(CHANNEL_METRIC + ".count", F.col("n")),
    )
    overall = F.array(series(SUCCESS_METRIC, round_half_up(percent * 100) / F.lit(100.0)))
    chosen = F.when(F.col("overall") == 1, overall).otherwise(each)
    return (
        sums.filter(F.col("n") > 0)
        .select("channel", F.explode(chosen).alias("s"))
        .select("s.series_id", "channel", F.lit(None).cast("string").alias("response_code"), at_ms.alias("timestamp_ms"), "s.value")
    )


def series_points(transactions: DataFrame, at_ms: Column) -> DataFrame:
    """`channel_series` and one series per transaction."""
    single = transactions.select(
        F.lit(TRANSACTION_METRIC).alias("series_id"),
        "channel",
        "response_code",
        at_ms.alias("timestamp_ms"),
        F.col("tat_millis").cast("double").alias("value"),
    )
    return single.unionByName(channel_series(transactions, at_ms))


# -- checks over the stored table ---------------------------------------------------------


def channel_report(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("tat_millis") > 0)
        .groupBy("channel")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            (F.sum("tat_millis").cast("double") / F.count(F.lit(1))).alias("avg_tat"),
            F.min("tat_millis").alias("min_tat"),
            F.max("tat_millis").alias("max_tat"),
        )
        .orderBy("channel")
    )


def code_report(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("response_code").agg(F.count(F.lit(1)).alias("cnt")).orderBy("response_code")


def match_report(transactions: DataFrame) -> DataFrame:
    return transactions.filter(F.col("tat_millis") > 0).agg(
        F.count(F.lit(1)).alias("matched"),
        F.coalesce(F.sum(_timed_out()), F.lit(0)).alias("timeouts"),
    )


def overall_report(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        F.count(F.lit(1)).alias("total"),
        F.round(F.sum("tat_millis").cast("double") / F.count(F.lit(1)), 2).alias("avg_tat"),
        F.min("tat_millis").alias("min_tat"),
        F.max("tat_millis").alias("max_tat"),
        F.coalesce(F.sum(_success()), F.lit(0)).alias("success_count"),
        F.coalesce(F.sum(_timed_out()), F.lit(0)).alias("timeout_count"),
    )


def total_count(rows: DataFrame, name: str = "total") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def transaction_listing(transactions: DataFrame) -> DataFrame:
    """Transactions by completion time. The id breaks ties, so that many rows of one instant
    can still be spread over the sorted output."""
    return transactions.select(
        "pair_id", "correlation_key", "stan", "channel", "tat_millis", "response_code", "completed_at"
    ).orderBy("completed_at", "pair_id")


def correlation_health(transactions: DataFrame) -> DataFrame:
    unmatched = F.coalesce(F.sum(_timed_out()), F.lit(0))
    matched = F.count(F.lit(1)) - unmatched
    return transactions.agg(
        matched.alias("matched"),
        unmatched.alias("unmatched"),
        F.round(matched * 100.0 / F.count(F.lit(1)), 2).alias("success_rate_pct"),
    )


# -- analysis ----------------------------------------------------------------------------


def latency_percentiles(transactions: DataFrame, groups: list, percents: tuple) -> DataFrame:
    """avg and nearest-rank percentiles per group."""
    ranks = {f"p{p}": Q.nearest_rank(p / 100) for p in percents}
    return _spread(transactions, groups, ranks).select(
        *groups, F.col("n").alias("cnt"), _mean().alias("avg_tat"), *ranks
    )


def latency_by_channel(transactions: DataFrame) -> DataFrame:
    return latency_percentiles(transactions.filter(F.col("channel").isNotNull()), ["channel"], (50, 95, 99))


def latency_by_code(transactions: DataFrame) -> DataFrame:
    return (
        transactions.filter(F.col("tat_millis") > 0)
        .groupBy("response_code")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            (F.sum("tat_millis").cast("double") / F.count(F.lit(1))).alias("avg_tat"),
            F.max("tat_millis").alias("max_tat"),
        )
    )


def latency_trend(transactions: DataFrame, seconds: int = 3600) -> DataFrame:
    return transactions.groupBy(
        bucket_start(F.col("completed_at"), seconds).alias("bucket_start"), "channel"
    ).agg((F.sum("tat_millis").cast("double") / F.count(F.lit(1))).alias("avg_tat"))


def slow_transactions(transactions: DataFrame, over_ms: int = 5000) -> DataFrame:
    return transactions.filter(F.col("tat_millis") > over_ms).select(
        "pair_id", "stan", "tat_millis", "channel", "response_code"
    )


def success_by_channel(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("channel").agg(
        F.sum(_success()).alias("success_count"),
        F.count(F.lit(1)).alias("total"),
        F.round(F.sum(_success()) * 100.0 / F.count(F.lit(1)), 2).alias("success_rate_pct"),
    )


def timeouts(transactions: DataFrame) -> DataFrame:
    return transactions.filter(
        (F.col("tat_millis") == TIMEOUT_TAT) & (F.col("response_code") == TIMEOUT_CODE)
    ).select("pair_id", "stan", "channel", "completed_at")


def timeouts_by_channel(transactions: DataFrame) -> DataFrame:
    return timeouts(transactions).groupBy("channel").agg(F.count(F.lit(1)).alias("cnt"))


def outliers_sigma(transactions: DataFrame, sigmas: float = 2.0) -> DataFrame:
    """Transactions slower than the mean by `sigmas` sample standard deviations."""
    border = transactions.agg(F.avg("tat_millis") + F.lit(sigmas) * F.stddev_samp("tat_millis")).scalar()
    return transactions.filter(F.col("tat_millis") > border).select(
        "pair_id", "stan", "tat_millis", "channel", "response_code"
    )


def p95_rank(transactions: DataFrame) -> DataFrame:
    """Channel and code by their 95th percentile, slowest first."""
    return latency_percentiles(
        transactions.filter(F.col("response_code").isNotNull()), ["channel", "response_code"], (95,)
    ).orderBy(F.desc("p95"), "channel", "response_code")


def success_trend(transactions: DataFrame, seconds: int = 3600) -> DataFrame:
    return transactions.groupBy(
        bucket_start(F.col("completed_at"), seconds).alias("bucket_start"), "channel"
    ).agg((F.sum(_success()).cast("double") / F.count(F.lit(1))).alias("success_rate"))


def window_stats(transactions: DataFrame, seconds: int = 60) -> DataFrame:
    """Per time bucket, channel and code; integer mean, clamped floor-index percentiles."""
    groups = ["bucket_start", "channel", "response_code"]
    timed = transactions.withColumn("bucket_start", bucket_start(F.col("completed_at"), seconds))
    ranks = {f"p{p}_ms": Q.clamped_floor_index(p) for p in (50, 95, 99)}
    remainder = F.col("total") % F.col("n")
    return _spread(timed, groups, ranks).select(
        *groups,
        F.col("n").alias("count"),
        F.col("total").alias("sum_ms"),
        ((F.col("total") - remainder) / F.col("n")).cast("bigint").alias("avg_ms"),
        F.col("low").alias("min_ms"),
        F.col("high").alias("max_ms"),
        *ranks,
    )


# -- over bucket rows ----------------------------------------------------------------------


def rollup_channel(buckets: DataFrame) -> DataFrame:
    """Unweighted mean of the bucket means, and volume, per channel."""
    return buckets.groupBy("channel").agg(
        F.avg("avg_latency_ms").alias("avg_of_avg"),
        F.sum("count").alias("total"),
        F.max("p95_latency_ms").alias("max_p95"),
        F.max("p99_latency_ms").alias("max_p99"),
    )


def rollup_code(buckets: DataFrame, code: str = "response_code") -> DataFrame:
    return buckets.groupBy(code).agg(F.max("p95_latency_ms").alias("max_p95"))


def rollup_success(buckets: DataFrame, code: str = "response_code") -> DataFrame:
    ok = F.sum(F.when(F.col(code) == SUCCESS_CODE, F.col("count")).otherwise(0))
    return buckets.agg((ok.cast("double") / F.sum("count")).alias("success_rate"))


def rollup_by(buckets: DataFrame, groups: list) -> DataFrame:
    """Mean of means and volume per server, log file or any other dimension."""
    return buckets.groupBy(*groups).agg(
        F.avg("avg_latency_ms").alias("avg_of_avg"), F.sum("count").alias("total")
    )


def cardinality(buckets: DataFrame, dimensions: list) -> DataFrame:
    """Number of distinct (bucket, dimensions) series."""
    return buckets.select("bucket_start", *dimensions).distinct().agg(F.count(F.lit(1)).alias("series"))


def approximate_cardinality(buckets: DataFrame, dimensions: list, error: float = 0.01) -> DataFrame:
    return buckets.agg(
        F.approx_count_distinct(F.struct("bucket_start", *dimensions), error).alias("series")
    )
