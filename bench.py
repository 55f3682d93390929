"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  folder of tables   (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores        (default 8)
    BENCH_QUERIES comma-separated subset
    BENCH_COPIES  copies of the event log for the end-to-end run (default 20)

Each query runs twice and the second time counts, so that code generation and the start of
Python workers are not measured; `cold` has the first times. Results go to the no-op sink: every
row and column is computed. The end-to-end run reads a log of JSON lines made from the events
table, copies of it under other keys: it parses, matches and aggregates to buckets in one query.
"""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from replylens.operators import parse
from replylens.operators.buckets import bucket_metrics
from replylens.operators.correlate import correlate
from replylens.operators.events import matchable
from replylens.plans import inputs
from replylens.plans.catalog import QUERIES
from replylens.session import build_session, scratch_path
from replylens.sources import files

HEADLINE = [
    "correlate",
    "correlate_hot_keys",
    "bucket_metrics",
    "bucket_metrics_approximate",
    "shipments_correlate",
    "shipments_bucket_metrics",
    "unmatched_requests",
    "event_dedup",
    "metric_points",
    "metric_documents",
    "parse_json_fields",
    "parse_json",
    "flatten_json",
    "parse_regex",
    "parse_blocks",
    "read_json_lines_correlate",
    "parse_regex_correlate",
    "read_blocks",
    "reject_malformed",
    "stream_correlate",
    "ingest_changed",
    "export_cycle",
    "stream_bucket_metrics",
    "correlate_legacy",
    "summary_stats",
    "window_stats",
]


def write_log(spark, sf_dir, copies):
    """JSON lines of all events, `copies` times under other keys; returns (folder, lines)."""
    path = scratch_path(spark, "log")
    records = inputs.click_records(spark, sf_dir).drop("event_id")
    many = records.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    key = F.concat_ws("-", "user_id", F.col("copy").cast("string")).alias("user_id")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts")
    line = F.to_json(F.struct(key, "event_type", at, "channel", "status"))
    many.select(line.alias("value")).write.text(path)
    return path, records.count() * copies


def lines_to_buckets(spark, path):
    fields = inputs.CLICKS.source_fields
    records = parse.parse_json_fields(parse.not_blank(files.read_lines(spark, path)), fields).filter("is_object")
    events = matchable(records, inputs.CLICKS).withColumn("event_id", F.monotonically_increasing_id())
    return bucket_metrics(correlate(events, inputs.CLICKS), inputs.CLICKS)


def timed(build):
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main():
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    copies = int(os.environ.get("BENCH_COPIES", "20"))
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
    }
    conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="replylens-bench-")
    spark = build_session("replylens-bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    cold, seconds = {}, {}
    for name in names or HEADLINE:
        cold[name] = timed(lambda: QUERIES[name](spark, sf_dir))
        seconds[name] = timed(lambda: QUERIES[name](spark, sf_dir))
        print(name, seconds[name], file=sys.stderr)
    result = {
        "metric": "total seconds of the headline queries, warm",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
        "cold": cold,
    }
    if not names:
        path, lines = write_log(spark, sf_dir, copies)
        first = timed(lambda: lines_to_buckets(spark, path))
        again = timed(lambda: lines_to_buckets(spark, path))
        result["lines_to_buckets"] = {
            "lines": lines,
            "cold_sec": first,
            "warm_sec": again,
            "lines_per_second": round(lines / again),
        }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
