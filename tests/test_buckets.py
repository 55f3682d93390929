import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from replylens import Blueprint, Metric, MetricType
from replylens.functions import bucket_start, latency_ms, mask_pan
from replylens.operators import points as M
from replylens.operators import quantiles as Q
from replylens.operators.buckets import approximate_bucket_metrics, bucket_metrics
from replylens.operators.reports import rollup_channel

BP = Blueprint(
    name="b",
    key_field="k",
    request_type_field="t",
    response_type_field="t",
    request_value="REQ",
    response_value="RESP",
    timestamp_field="ts",
    dimensions=("channel", "response_code"),
    metrics=[
        Metric("custom.duration", MetricType.HISTOGRAM),
        Metric("custom.operations", MetricType.COUNTER),
        Metric("custom.rate", MetricType.RATE),
    ],
)


def pairs(spark, rows):
    df = spark.createDataFrame(
        [(ts, ms, o, c, r) for ts, ms, o, c, r in rows],
        "response_ts string, latency_ms long, outcome string, channel string, response_code string",
    )
    return df.withColumn("response_ts", F.col("response_ts").cast("timestamp"))


def test_two_buckets(spark):
    rows = bucket_metrics(
        pairs(
            spark,
            [
                ("2026-10-01 10:00:05", 5000, "SUCCESS", "ATM", "000"),
                ("2026-10-01 10:00:59.999", 7000, "SUCCESS", "ATM", "000"),
                ("2026-10-01 10:01:00", 3000, "ERROR", "POS", "500"),
                ("2026-10-01 10:01:00", -1, "ERROR", "POS", "500"),
                (None, 10, "ERROR", "POS", "500"),
            ],
        ),
        BP,
    ).collect()
    atm, pos = sorted(rows, key=lambda r: r["channel"])
    assert (atm["count"], atm["avg_latency_ms"], atm["min_latency_ms"], atm["max_latency_ms"]) == (2, 6000, 5000, 7000)
    assert (atm["success_rate"], atm["error_rate"], atm["throughput"]) == (1.0, 0.0, 2 / 60)
    assert str(atm["bucket_start"]) == "2026-10-01 10:00:00" and str(pos["bucket_start"]) == "2026-10-01 10:01:00"
    assert (pos["count"], pos["success_rate"], pos["error_rate"]) == (1, 0.0, 1.0)


def test_unknown_outcomes_and_absent_dimensions(spark):
    rows = [("2026-10-01 10:00:00", 1, "UNKNOWN", None, ""), ("2026-10-01 10:00:01", 2, "UNKNOWN", None, "")]
    (row,) = bucket_metrics(pairs(spark, rows + [(rows[0][0], 9, "UNKNOWN", "", "")]), BP).filter("channel IS NULL").collect()
    assert (row["count"], row["success_rate"], row["error_rate"]) == (2, 0.0, 0.0)


def test_p95_nearest_rank(spark):
    rows = [("2026-10-01 10:00:00", ms, "SUCCESS", "A", "0") for ms in (100, 200, 300, 400, 500)]
    for bp in (BP, Blueprint(**{**BP.__dict__, "timeout": timedelta(days=9)})):
        assert bucket_metrics(pairs(spark, rows), bp).first()["p95_latency_ms"] == 500
        assert bucket_metrics(pairs(spark, rows), bp, per_task=0).first()["p95_latency_ms"] == 500


@pytest.mark.parametrize("bounded", [True, False])
def test_quantiles_equal_sorting(spark, bounded):
    rng = random.Random(3)
    data = []
    for g, n in enumerate([1, 2, 3, 19, 20, 21, 100, 700]):
        spread = rng.choice([3, 5000, 10_000_000])
        data += [(None if g == 0 else f"g{g}", rng.randrange(-spread, spread)) for _ in range(n)]
    df = spark.createDataFrame(data, "g string, v long")
    ranks = {"p50": Q.nearest_rank(0.5), "p95": Q.nearest_rank(0.95), "f50": Q.floor_index(50), "f99": Q.clamped_floor_index(99)}
    got = Q.summarise(Q.value_counts(df, ["g"], "v"), ["g"], "v", ranks, per_task=1000 if bounded else 0)
    for row in got.collect():
        v = sorted(x for g, x in data if g == row["g"])
        n = len(v)
        assert (row["n"], row["total"], row["low"], row["high"]) == (n, sum(v), v[0], v[-1])
        assert row["p50"] == v[max(0, math.ceil(0.5 * n) - 1)] and row["p95"] == v[max(0, math.ceil(0.95 * n) - 1)]
        assert row["f50"] == (v[int(0.5 * n)] if int(0.5 * n) < n else None)
        assert row["f99"] == v[min(int(99 / 100.0 * n), n - 1)]


def test_approximation_is_near(spark):
    rows = [("2026-10-01 10:00:00", ms, "SUCCESS", "A", "0") for ms in range(1, 1001)]
    row = approximate_bucket_metrics(pairs(spark, rows), BP).first()
    assert row["count"] == 1000 and abs(row["p95_latency_ms"] - 950) <= 2


def test_sum_overflow_is_an_error(spark):
    rows = [("2026-10-01 10:00:00", 1 << 62, "SUCCESS", "A", "0"), ("2026-10-01 10:00:00", (1 << 62) + 1, "SUCCESS", "A", "0")]
    with pytest.raises(Exception, match="(?i)overflow"):
        bucket_metrics(pairs(spark, rows), BP).collect()


def test_scalars(spark):
    row = (
        spark.sql("SELECT timestamp'2026-10-01 10:00:00' a, timestamp'2026-10-01 10:00:00.0019' b, timestamp'1969-12-31 23:59:30' c")
        .select(
            latency_ms(F.col("a"), F.col("b")).alias("ms"),
            latency_ms(F.col("b"), F.col("a")).alias("back"),
            bucket_start(F.col("c"), 60).alias("old"),
            mask_pan(F.lit("1234")).alias("short"),
            mask_pan(F.lit("4111111111111111")).alias("long"),
        )
        .first()
    )
    assert (row["ms"], row["back"], str(row["old"])) == (1, -1, "1970-01-01 00:00:00")
    assert (row["short"], row["long"]) == ("****", "****1111")


def bucket_row(spark, channel="ATM"):
    return spark.sql(
        f"""SELECT timestamp'2026-10-01 10:00:00' bucket_start, 60L bucket_seconds, '{channel}' channel,
        CAST(NULL AS STRING) response_code, 3L count, 2L success_count, 1L error_count, 100L min_latency_ms,
        900L max_latency_ms, 550.0D avg_latency_ms, 850L p95_latency_ms, 1000L p99_latency_ms,
        2/3D success_rate, 1/3D error_rate, 0.05D throughput"""
    )


def test_document(spark):
    import json

    text = M.metric_documents(bucket_row(spark, 'A\\"B'), BP, prefix="x.", service="svc").first()["document"]
    resource = json.loads(text)["resourceMetrics"][0]
    assert resource["resource"]["attributes"] == [{"key": "service.name", "value": {"stringValue": "svc"}}]
    scope = resource["scopeMetrics"][0]
    assert scope["scope"] == {"name": "svc"}
    histogram, counter, rate = scope["metrics"]
    start = 1790848800 * 10**9
    times = {"startTimeUnixNano": str(start), "timeUnixNano": str(start + 60 * 10**9)}
    common = {**times, "attributes": [{"key": "channel", "value": {"stringValue": 'A"B'}}]}
    assert histogram == {
        "name": "x.custom.duration",
        "histogram": {
            "dataPoints": [{**common, "count": "3", "sum": 1650.0, "bucketCounts": ["3"], "explicitBounds": []}],
            "aggregationTemporality": 1,
        },
    }
    assert counter == {
        "name": "x.custom.operations",
        "sum": {"dataPoints": [{**common, "asInt": "3"}], "aggregationTemporality": 1, "isMonotonic": True},
    }
    assert rate == {"name": "x.custom.rate", "gauge": {"dataPoints": [{**common, "asDouble": 0.05}]}}


def test_default_metrics_and_prefix(spark):
    bp = Blueprint(**{**BP.__dict__, "metrics": ()})
    names = [r["metric"] for r in M.metric_points(bucket_row(spark), bp).collect()]
    assert names == ["replylens.event.latency", "replylens.event.count", "replylens.event.throughput_per_second"]
    assert M.metric_name("p.a", "p.") == "p.a" and M.metric_name("a", "p.") == "p.a"


def test_rollup_mean_is_unweighted(spark):
    rows = [("2026-10-01 10:00:00", 10, "SUCCESS", "A", "0")] * 3 + [("2026-10-01 10:01:00", 50, "SUCCESS", "A", "0")]
    row = rollup_channel(bucket_metrics(pairs(spark, rows), BP)).first()
    assert (row["avg_of_avg"], row["total"]) == (30.0, 4)
