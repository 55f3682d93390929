"""What can be merged against figures over all rows, packed documents, and ranks by digits."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from replylens import Blueprint
from replylens.operators import points as M
from replylens.operators import quantiles as Q
from replylens.operators import sketches as Z

BP = Blueprint(
    name="merge", key_field="key", request_type_field="kind", response_type_field="kind", request_value="q",
    response_value="p", timestamp_field="at", dimensions=("place",), granularity="1m",
)


@pytest.mark.parametrize("shift", [0, 10**9])
def test_merged_moments_equal_one_pass(spark, tmp_path, shift):
    rng = random.Random(1)
    values = [shift + rng.gauss(5, 3) * (1 + i // 300) for i in range(900)]
    rows = spark.createDataFrame([(i // 300, i % 2, float(v)) for i, v in enumerate(values)], "batch int, g int, v double")
    parts = Z.moments(rows, "v", ["batch", "g"]).unionByName(spark.createDataFrame([(9, 0, 0, None, None)], "batch int, g int, n long, mean double, m2 double"))
    merged = Z.merge_moments(parts, []).first()
    mean = math.fsum(values) / len(values)
    m2 = math.fsum((v - mean) ** 2 for v in values)
    assert merged.n == 900 and math.isclose(merged["mean"], mean, rel_tol=1e-12) and math.isclose(merged.m2, m2, rel_tol=1e-6)
    assert {r.g: r.n for r in Z.merge_moments(parts, ["g"]).collect()} == {0: 450, 1: 450}
    for batch in range(3):
        found = Z.outliers_of_batch(spark, rows.filter(F.col("batch") == batch), "v", str(tmp_path), batch)
        seen = values[: 300 * (batch + 1)]
        mean = math.fsum(seen) / len(seen)
        border = mean + 2 * math.sqrt(math.fsum((v - mean) ** 2 for v in seen) / (len(seen) - 1))
        assert sorted(r.v for r in found.collect()) == sorted(v for v in seen[300 * batch :] if v > border)


def test_sketches_merge_within_their_errors(spark):
    rng = random.Random(2)
    n = 20_000
    rows = [(f"k{rng.randrange(5000)}", rng.randrange(60), int(rng.expovariate(0.001)), i % 3, "ab"[i % 2]) for i in range(n)]
    pairs = spark.createDataFrame(rows, "correlation_key string, minute int, latency_ms long, delta int, place string").withColumn(
        "response_ts", F.timestamp_seconds(F.col("minute") * 60)
    )
    sketched = Z.bucket_sketches(pairs, BP, per=["delta"])
    assert sketched.count() == 360
    # In two steps, as late rows are added to a roll-up that exists already.
    hourly = Z.merge_sketches(sketched, ["delta", "place"])
    for row in Z.merge_sketches(hourly, ["place"]).select("*", Z.latency_at(0.95).alias("p95"), Z.distinct_keys().alias("keys")).collect():
        mine = [r for r in rows if r[4] == row.place]
        below = sum(r[2] <= row.p95 for r in mine) / len(mine)
        assert row["count"] == len(mine) and abs(below - 0.95) <= 2 * Z.KLL_RANK_ERROR
        distinct = len({r[0] for r in mine})
        assert abs(row["keys"] - distinct) <= 5 * Z.HLL_ERROR * distinct
        assert math.isclose(row["mean"], sum(r[2] for r in mine) / len(mine), rel_tol=1e-9)


def buckets(spark, n):
    rows = [(i * 60, f"place {i % 5} \" ü" if i % 7 else None, i + 1) for i in range(n)]
    made = spark.createDataFrame(rows, "at long, place string, count long").withColumn("bucket_start", F.timestamp_seconds("at"))
    figures = ("success_count", "error_count", "min_latency_ms", "max_latency_ms", "p95_latency_ms", "p99_latency_ms")
    made = made.select("bucket_start", F.lit(60).cast("long").alias("bucket_seconds"), "place", "count", *[F.lit(1).cast("long").alias(f) for f in figures])
    return made.withColumns({c: F.lit(0.5) for c in ("avg_latency_ms", "success_rate", "error_rate", "throughput")})


@pytest.mark.parametrize("most", [4_000, 1 << 20])
def test_packed_documents_hold_each_point_once(spark, monkeypatch, most):
    monkeypatch.setattr(M, "PART_BYTES", 50_000)
    given = buckets(spark, 200)
    rows = M.packed_documents(given, BP, most_bytes=most).collect()
    assert all(len(r.document.encode()) < most for r in rows) and sum(r.buckets for r in rows) == 200
    assert len(rows) < 200 and (most > 4_000 or len(rows) > 20)

    def points(document):
        for metric in json.loads(document)["resourceMetrics"][0]["scopeMetrics"][0]["metrics"]:
            (kind,) = set(metric) - {"name"}
            for point in metric[kind]["dataPoints"]:
                yield metric["name"], kind, json.dumps({**metric[kind], "dataPoints": point}, sort_keys=True)

    single = [p for r in M.metric_documents(given, BP).collect() for p in points(r.document)]
    assert sorted(p for r in rows for p in points(r.document)) == sorted(single)
    assert M.packed_documents(given.limit(0), BP).collect() == []


def test_ranks_by_digits(spark):
    rng = random.Random(3)
    spans = (lambda: rng.randrange(-5, 5), lambda: rng.randrange(10**9), lambda: rng.randrange(-(2**48), 2**48))
    rows = [(rng.choice(["a", "b", None]), rng.choice(spans)()) for _ in range(2000)] + [("one", 7)]
    df = spark.createDataFrame(rows, "g string, v long")
    ranks = {"p50": Q.nearest_rank(0.5), "p95": Q.floor_index(95), "p99": Q.clamped_floor_index(99)}
    for groups in (["g"], []):
        counts = Q.value_counts(df, groups, "v", {"w": F.lit(1)})
        direct, radix = (sorted(map(tuple, Q.summarise(counts, groups, "v", ranks, ["w"], **o).collect()), key=repr) for o in ({}, {"per_task": 1}))
        assert [r[: len(groups) + 1] for r in direct] == [r[: len(groups) + 1] for r in radix] and direct == radix
    plan = Q.summarise(Q.value_counts(df, [], "v"), [], "v", ranks, per_task=1)
    assert plan.count() == 1
