"""Every registered query: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.blueprint import granularity_seconds
from replylens.functions import bucket_start, hash_key, mask_pan, once, strict_instant
from replylens.operators import buckets as B
from replylens.operators import correlate as C
from replylens.operators import dedup as D
from replylens.operators import events as E
from replylens.operators import legacy as L
from replylens.operators import parse as P
from replylens.operators import points as M
from replylens.operators import reports as R
from replylens.operators import sketches as Z
from replylens.plans import inputs as I
from replylens.session import cut_lineage, scratch_path
from replylens.sources import files, tables
from replylens.streaming import export as X
from replylens.streaming import state as K
from replylens.streaming import tail as S

QUERIES = {}
EVENT_VIEW = ["event_id", "correlation_key", "event_ts"]


def query(function):
    def run(spark, sf_dir):
        return I.portable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def as_of():
    return F.lit(I.AS_OF).cast("timestamp")


def at_ms():
    return F.lit(I.AT_MS).cast("bigint")


def _click_pairs(spark, sf_dir, **options):
    return C.correlate(I.click_events(spark, sf_dir), I.CLICKS, **options)


def _click_buckets(spark, sf_dir):
    return B.bucket_metrics(_click_pairs(spark, sf_dir), I.CLICKS)


def _messages(spark, sf_dir):
    return L.mti_filter(I.card_messages(spark, sf_dir))


def _done(spark, sf_dir, **options):
    return L.correlate_legacy(_messages(spark, sf_dir), **options)


def _transactions(spark, sf_dir):
    return L.transaction_table(_messages(spark, sf_dir), as_of(), I.TIMEOUT_MINUTES)


# -- events and matching -------------------------------------------------------------------


@query
def event_classify(spark, sf_dir):
    records = I.click_records(spark, sf_dir)
    return E.classify(records, I.CLICKS).select(
        "event_id", F.col("user_id").alias("correlation_key"), "event_type", "role"
    )


@query
def correlate(spark, sf_dir):
    return _click_pairs(spark, sf_dir)


@query
def correlate_hot_keys(spark, sf_dir):
    """Every key with more than 20 events is matched in segments of about 500 rows."""
    return _click_pairs(spark, sf_dir, hot_rows=20, per_segment=500)


@query
def correlate_timeout_6h(spark, sf_dir):
    bp = replace(I.CLICKS, timeout=timedelta(hours=6))
    return C.correlate(I.click_events(spark, sf_dir), bp)


@query
def correlate_carry_over(spark, sf_dir):
    return C.correlate_passes(I.click_events(spark, sf_dir), I.CLICKS, passes=2)


@query
def scan_pending(spark, sf_dir):
    events = I.click_events(spark, sf_dir)
    return C.pending(events, C.correlate(events, I.CLICKS)).select(*EVENT_VIEW)


@query
def unmatched_requests(spark, sf_dir):
    events = I.click_events(spark, sf_dir)
    return C.unmatched_requests(events, C.correlate(events, I.CLICKS)).select(*EVENT_VIEW)


@query
def orphan_responses(spark, sf_dir):
    events = I.click_events(spark, sf_dir)
    return C.orphan_responses(events, C.correlate(events, I.CLICKS)).select(*EVENT_VIEW)


@query
def expired_requests(spark, sf_dir):
    events = I.click_events(spark, sf_dir)
    unmatched = C.unmatched_requests(events, C.correlate(events, I.CLICKS))
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return C.timeout_rows(unmatched, as_of, minutes=1).select(*EVENT_VIEW)


def _with_gaps(spark, sf_dir, gap):
    channel = F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 2 == 0), F.lit(gap))
    records = I.click_records(spark, sf_dir)
    return E.matchable(records.withColumn("channel", channel.otherwise(F.col("channel"))), I.CLICKS)


@query
def dimension_empty_wins(spark, sf_dir):
    """An empty dimension of the response is present and hides the request's value."""
    return C.correlate(_with_gaps(spark, sf_dir, ""), I.CLICKS)


@query
def dimension_empty_as_null(spark, sf_dir):
    return C.correlate(_with_gaps(spark, sf_dir, ""), I.CLICKS, empty_as_null=True)


@query
def shipments_correlate(spark, sf_dir):
    """Orders and line items: request and response told by different fields."""
    return C.correlate(E.matchable(I.shipment_records(spark, sf_dir), I.SHIPMENTS), I.SHIPMENTS)


@query
def shipments_bucket_metrics(spark, sf_dir):
    return B.bucket_metrics(shipments_correlate(spark, sf_dir), I.SHIPMENTS)


@query
def shipments_match_rate(spark, sf_dir):
    events = E.matchable(I.shipment_records(spark, sf_dir), I.SHIPMENTS)
    pairs = C.correlate(events, I.SHIPMENTS)
    marked = events.join(C.matched_ids(pairs).withColumn("used", F.lit(True)), "event_id", "left")
    free = F.col("used").isNull()
    return marked.agg(
        F.count_if(~free & (F.col("role") == E.REQUEST)).alias("matched"),
        F.count_if(free & (F.col("role") == E.REQUEST)).alias("unmatched_requests"),
        F.count_if(free & (F.col("role") == E.RESPONSE)).alias("orphan_responses"),
    )


@query
def turns_correlate(spark, sf_dir):
    return C.correlate(E.matchable(I.turn_records(spark, sf_dir), I.TURNS), I.TURNS)


@query
def turns_bucket_metrics(spark, sf_dir):
    return B.bucket_metrics(turns_correlate(spark, sf_dir), I.TURNS)


@query
def valid_events(spark, sf_dir):
    """Blank keys and missing times are dropped; a key is not trimmed."""
    key, ts = F.col("correlation_key"), F.col("event_ts")
    events = E.normalise(I.click_records(spark, sf_dir), I.CLICKS).withColumns(
        {
            "correlation_key": F.when(F.col("event_id") % 7 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), key)),
            "event_ts": F.when(F.col("event_id") % 11 != 0, ts),
        }
    )
    return E.valid_events(events).select("event_id", "correlation_key", "event_ts")


@query
def core_fields(spark, sf_dir):
    """Records without key, type or time are skipped; the type may come from either type field."""
    number = F.col("orderkey").cast("bigint")
    records = I.shipment_records(spark, sf_dir).withColumns(
        {
            "orderkey": F.when(number % 5 != 0, F.col("orderkey")),
            "ts": F.when(number % 7 != 0, F.col("ts")),
            "reply": F.when(number % 3 != 0, F.col("reply")),
        }
    )
    return E.require_core_fields(records, I.SHIPMENTS).select("event_id", "orderkey", E.event_type(I.SHIPMENTS).alias("event_type"))


@query
def correlated_flags(spark, sf_dir):
    """Each event with the mark that a pair has used it."""
    events = I.click_events(spark, sf_dir)
    used = C.matched_ids(C.correlate(events, I.CLICKS)).withColumn("used", F.lit(True))
    flagged = events.join(used, "event_id", "left")
    return flagged.select("event_id", F.coalesce("used", F.lit(False)).alias("correlated"))


@query
def write_pairs(spark, sf_dir):
    """The pair table, written and read back."""
    root = scratch_path(spark, "pairs")
    tables.write_batch(_with_stored_ids(_click_pairs(spark, sf_dir)), f"{root}/pairs", 0)
    pairs = tables.read_batches(spark, f"{root}/pairs", tables.pair_schema(I.CLICKS)).drop("batch_id")
    return pairs.withColumns({c: F.col(c)["row"] for c in ("pair_id", "request_id", "response_id")})


# -- buckets and points ----------------------------------------------------------------------


@query
def bucket_metrics(spark, sf_dir):
    return _click_buckets(spark, sf_dir)


@query
def bucket_metrics_by_cell(spark, sf_dir):
    """Percentiles as for groups with too many distinct latencies for one task."""
    return B.bucket_metrics(_click_pairs(spark, sf_dir), I.CLICKS, per_task=0)


@query
def bucket_metrics_hourly(spark, sf_dir):
    bp = replace(I.CLICKS, timeout=timedelta(hours=1), granularity="1h")
    return B.bucket_metrics(C.correlate(I.click_events(spark, sf_dir), bp), bp)


@query
def granularity(spark, sf_dir):
    """Pairs per bucket under four granularities."""
    widths = ("30s", "5m", "6h", "2d")
    starts = [
        F.struct(F.lit(w).alias("width"), bucket_start(F.col("response_ts"), granularity_seconds(w)).alias("b"))
        for w in widths
    ]
    exploded = _click_pairs(spark, sf_dir).select(F.explode(F.array(*starts)).alias("p"))
    return exploded.groupBy(F.col("p.width").alias("width"), F.col("p.b").alias("bucket_start")).agg(
        F.count(F.lit(1)).alias("count")
    )


@query
def bucket_metrics_per_batch(spark, sf_dir):
    """One delta per export batch: a bucket that spans batches has several rows."""
    pairs = _click_pairs(spark, sf_dir).withColumn("batch", F.col("pair_id") % 3)
    return B.bucket_metrics(pairs, I.CLICKS, per=["batch"])


@query
def bucket_metrics_approximate(spark, sf_dir):
    """The exact figures, and whether the approximate percentiles are within the declared rank error."""
    pairs, accuracy = cut_lineage(_click_pairs(spark, sf_dir)), 1000
    groups = ["bucket_start", "channel"]
    near = B.approximate_bucket_metrics(pairs, I.CLICKS, accuracy)
    timed = B.bucket_time(pairs, I.CLICKS).join(near.select(*groups, "p95_latency_ms", "p99_latency_ms"), groups)
    checks = []
    for name, q in (("p95_latency_ms", 0.95), ("p99_latency_ms", 0.99)):
        below, upto = (F.sum(c.cast("bigint")) for c in (F.col("latency_ms") < F.col(name), F.col("latency_ms") <= F.col(name)))
        wanted, slack = F.ceil(F.lit(q) * F.count("*")), F.ceil(F.count("*") / accuracy)
        checks.append((below < wanted + slack) & (upto >= wanted - slack))
    within = timed.groupBy(*groups).agg((checks[0] & checks[1]).alias("within_error"))
    return near.drop("p95_latency_ms", "p99_latency_ms").join(within, groups)


@query
def bucket_time_fallback(spark, sf_dir):
    """Pairs without a response time take the request's; without both they are left out."""
    even, third = F.col("pair_id") % 2 == 0, F.col("pair_id") % 3 == 0
    pairs = _click_pairs(spark, sf_dir).select(
        "pair_id",
        "latency_ms",
        F.when(~even & ~third, F.col("response_ts")).alias("response_ts"),
        F.when(even & ~third, F.col("request_ts")).alias("request_time"),
    )
    return B.bucket_time(pairs, I.CLICKS).groupBy("bucket_start").agg(F.count(F.lit(1)).alias("count"))


@query
def metric_points(spark, sf_dir):
    return M.metric_points(_click_buckets(spark, sf_dir), I.CLICKS)


@query
def histogram_points(spark, sf_dir):
    return metric_points(spark, sf_dir).filter("type = 'HISTOGRAM'")


@query
def counter_points(spark, sf_dir):
    return metric_points(spark, sf_dir).filter("type = 'COUNTER'")


@query
def gauge_points(spark, sf_dir):
    return metric_points(spark, sf_dir).filter("type IN ('GAUGE', 'RATE')")


@query
def metric_documents(spark, sf_dir):
    """The export documents, one per bucket row, read back point by point."""
    return _read_points(M.metric_documents(_click_buckets(spark, sf_dir), I.CLICKS))


@query
def packed_documents(spark, sf_dir):
    """Export documents of many buckets, below 16 KiB each, read back point by point."""
    documents = M.packed_documents(_click_buckets(spark, sf_dir), I.CLICKS, most_bytes=16_384)
    return _read_points(documents.filter(F.octet_length("document") < 16_384))


def _read_points(documents):
    point = (
        "startTimeUnixNano string, timeUnixNano string, attributes array<struct<key string, value "
        "struct<stringValue string>>>, count string, sum double, asInt string, asDouble double"
    ).replace(" string", ": string").replace(" double", ": double").replace("attributes array", "attributes: array")
    point = point.replace("value struct", "value: struct")
    body = f"struct<dataPoints: array<struct<{point}>>>"
    schema = (
        "resourceMetrics array<struct<scopeMetrics: array<struct<metrics: array<struct<name: string, "
        f"histogram: {body}, sum: {body}, gauge: {body}>>>>>>"
    )
    metric = documents.select(F.from_json("document", schema).alias("d")).select(
        F.explode(F.col("d.resourceMetrics")[0]["scopeMetrics"][0]["metrics"]).alias("m")
    )
    kinds = {m.name: m.type.value for m in I.CLICKS.metrics}
    kind = F.element_at(F.create_map(*[F.lit(x) for n, t in kinds.items() for x in (M.metric_name(n), t)]), F.col("m.name"))
    points = F.explode(F.coalesce("m.histogram", "m.sum", "m.gauge")["dataPoints"])
    return metric.select(F.col("m.name").alias("metric"), kind.alias("type"), points.alias("p")).select(
        F.col("p.attributes")[0]["value"]["stringValue"].alias("channel"),
        "metric",
        "type",
        F.col("p.startTimeUnixNano").alias("start_ns"),
        F.col("p.timeUnixNano").alias("end_ns"),
        F.coalesce("p.count", "p.asInt").alias("whole"),
        F.coalesce("p.sum", "p.asDouble").alias("real"),
    )


def _coded_buckets(spark, sf_dir):
    bp = replace(I.CLICKS, dimensions=("channel", "response_code"), status_field="response_code")
    records = I.click_records(spark, sf_dir).withColumnRenamed("status", "response_code")
    return B.bucket_metrics(C.correlate(E.matchable(records, bp), bp), bp)


def _rounded(df, column="avg_of_avg"):
    # The order of a floating-point sum is not fixed, so its last digits are not either.
    return df.withColumn(column, F.round(column, 6))


@query
def rollup_channel(spark, sf_dir):
    return _rounded(R.rollup_channel(_click_buckets(spark, sf_dir)))


@query
def rollup_code(spark, sf_dir):
    return R.rollup_code(_coded_buckets(spark, sf_dir))


@query
def rollup_success(spark, sf_dir):
    return R.rollup_success(_coded_buckets(spark, sf_dir))


@query
def rollup_by_server(spark, sf_dir):
    server = F.concat(F.lit("srv-"), (F.col("pair_id") % 4).cast("string"))
    pairs = _click_pairs(spark, sf_dir).withColumn("server", server)
    return _rounded(R.rollup_by(B.bucket_metrics(pairs, I.CLICKS, per=["server"]), ["server", "channel"]))


@query
def rollup_sketches(spark, sf_dir):
    """Sketches of three deltas of every bucket, merged to channels; p95 and distinct keys against exact ones."""
    pairs = cut_lineage(_click_pairs(spark, sf_dir).withColumn("delta", F.col("pair_id") % 3))
    merged = Z.merge_sketches(Z.bucket_sketches(pairs, I.CLICKS, per=["delta"]), ["channel"])
    merged = merged.select(
        "channel", "count", Z.latency_at(0.95).alias("p95"), Z.distinct_keys().alias("keys"),
        F.round("mean", 4).alias("mean_ms"), F.round(F.sqrt(F.col("m2") / (F.col("count") - 1)), 4).alias("deviation_ms"),
    )
    named = merged.select(F.col("channel").alias("of"), "p95")
    exact = (
        pairs.join(named, F.col("channel") == F.col("of"))
        .groupBy("of")
        .agg(
            F.avg((F.col("latency_ms") < F.col("p95")).cast("int")).alias("below"),
            F.avg((F.col("latency_ms") <= F.col("p95")).cast("int")).alias("up_to"),
            F.count_distinct("correlation_key").alias("distinct"),
        )
    )
    ranked = (F.col("below") <= 0.95 + 2 * Z.KLL_RANK_ERROR) & (F.col("up_to") >= 0.95 - 2 * Z.KLL_RANK_ERROR)
    close = F.abs(F.col("keys") - F.col("distinct")) <= 5 * Z.HLL_ERROR * F.col("distinct")
    return merged.join(exact, F.col("channel") == F.col("of")).select(
        "channel", "count", "mean_ms", "deviation_ms", ranked.alias("p95_within_error"), close.alias("keys_within_error")
    )


@query
def outliers_per_batch(spark, sf_dir):
    """Outliers of the last of three batches, by the merged moments of all; earlier batches are not read again."""
    root = scratch_path(spark, "moments")
    done = cut_lineage(_transactions(spark, sf_dir))
    batches = [done.filter(F.col("pair_id") % 3 == i) for i in range(3)]
    for number in range(2):
        Z.store_moments(batches[number], "tat_millis", root, number)
    late = Z.outliers_of_batch(spark, batches[2], "tat_millis", root, 2)
    return late.select("pair_id", "stan", "tat_millis", "channel", "response_code")


@query
def cardinality(spark, sf_dir):
    return R.cardinality(_click_buckets(spark, sf_dir), ["channel"])


@query
def cardinality_approximate(spark, sf_dir):
    """The exact number, and whether the estimate is within five declared standard errors."""
    buckets, error = cut_lineage(_click_buckets(spark, sf_dir)), 0.01
    near = R.approximate_cardinality(buckets, ["channel"], error).withColumnRenamed("series", "estimate")
    exact = R.cardinality(buckets, ["channel"])
    within = F.abs(F.col("estimate") - F.col("series")) <= 5 * error * F.col("series")
    # Two tables of one row each.
    return exact.withColumn("one", F.lit(1)).join(near.withColumn("one", F.lit(1)), "one").select("series", within.alias("within_error"))


# -- identity, ledgers, exports ----------------------------------------------------------------


def _doubled(records: DataFrame) -> DataFrame:
    """Every record twice; the copies have later ids."""
    return records.unionByName(records.withColumn("event_id", F.col("event_id") + 1_000_000_000_000))


def _deduped(spark, sf_dir):
    events = E.valid_events(E.normalise(_doubled(I.click_records(spark, sf_dir)), I.CLICKS))
    hashed = D.with_event_hash(events, D.payload(D.columns_as_fields(I.CLICKS.carried_columns)))
    return D.dedup_events(hashed)


@query
def event_dedup(spark, sf_dir):
    return _deduped(spark, sf_dir).select("event_id", "correlation_key", "event_type", "event_ts", "channel")


@query
def event_dedup_correlate(spark, sf_dir):
    return C.correlate(_deduped(spark, sf_dir), I.CLICKS)


@query
def pair_dedup(spark, sf_dir):
    pairs = _click_pairs(spark, sf_dir)
    copies = pairs.withColumn("pair_id", F.col("pair_id") + 1_000_000_000_000)
    return D.dedup_pairs(pairs.unionByName(copies))


@query
def export_anti_join(spark, sf_dir):
    pairs = _click_pairs(spark, sf_dir)
    exports = pairs.filter(F.col("pair_id") % 3 == 0).select("pair_id")
    return tables.unexported(pairs, exports, limit=None)


@query
def scan_unexported(spark, sf_dir):
    """The next 100 pairs by id: the batch limit is the operator."""
    pairs = _click_pairs(spark, sf_dir)
    exports = pairs.filter(F.col("pair_id") % 3 == 0).select("pair_id")
    return tables.unexported(pairs, exports, limit=100)


def _with_stored_ids(pairs):
    """Ids as stored events have them."""
    stored = lambda c: F.struct(F.lit(0).cast("bigint").alias("batch"), F.col(c).alias("row"))
    return pairs.withColumns({c: stored(c) for c in ("pair_id", "request_id", "response_id")})


@query
def export_cycle(spark, sf_dir):
    """Store, export everything, export again: the second run finds nothing."""
    root = scratch_path(spark, "export")
    tables.write_batch(_with_stored_ids(_click_pairs(spark, sf_dir)), f"{root}/pairs", 0)

    def deliver(buckets):
        tables.write_documents(buckets, I.CLICKS, f"{root}/documents")

    first = tables.export_once(spark, I.CLICKS, root, deliver, limit=None)
    second = tables.export_once(spark, I.CLICKS, root, deliver, limit=None)
    return spark.range(1).select(
        F.lit(first).cast("bigint").alias("first_run"), F.lit(second).cast("bigint").alias("second_run")
    )


@query
def ingest_replay(spark, sf_dir):
    """The same records stored twice give each event once."""
    root = scratch_path(spark, "replay")
    records = I.click_records(spark, sf_dir).drop("event_id")
    events = E.normalise(records, I.CLICKS)
    tables.store_events(events, I.CLICKS, root, 0)
    tables.store_events(events, I.CLICKS, root, 1)
    stored = tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(I.CLICKS))
    return stored.select("correlation_key", "event_type", "event_ts", "channel", "status")


# -- text records --------------------------------------------------------------------------------


def _instant(ts="ts"):
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


JSON_FIELDS = ["event_id", "user_id", "event_type", "ts", "meta.channel", "meta.status", "tags"]


def _json_lines(spark, sf_dir):
    records = I.click_records(spark, sf_dir)
    meta = F.struct("channel", "status", F.lit(None).cast("string").alias("nothing"))
    tags = F.array(F.lit(1).cast("bigint"), F.col("event_id") % 7)
    line = F.struct("event_id", "user_id", "event_type", _instant().alias("ts"), meta.alias("meta"), tags.alias("tags"))
    return once(records, [F.to_json(line).alias("value")]).select("event_id", "value")


def _underscored(df):
    return df.select(*[F.col(f"`{c}`").alias(c.replace(".", "_")) for c in JSON_FIELDS])


@query
def parse_json(spark, sf_dir):
    lines = _json_lines(spark, sf_dir).select("value")
    return _underscored(P.fields_as_columns(P.parse_json(lines), JSON_FIELDS))


@query
def flatten_json(spark, sf_dir):
    lines = _json_lines(spark, sf_dir).select("value")
    return _underscored(P.fields_as_columns(P.flatten_json(lines), JSON_FIELDS))


@query
def parse_json_fields(spark, sf_dir):
    return _underscored(P.parse_json_fields(_json_lines(spark, sf_dir).select("value"), JSON_FIELDS))


NESTED = replace(I.CLICKS, dimensions=("meta.channel",), status_field="meta.status")


def _as_clicks(pairs):
    return pairs.withColumnRenamed("meta_channel", "channel")


def _parse_nested(lines):
    parsed = P.parse_json_fields(P.not_blank(lines), ["event_id", *NESTED.source_fields])
    return parsed.filter("is_object").withColumn("event_id", F.col("event_id").cast("bigint"))


@query
def read_json_lines_correlate(spark, sf_dir):
    """Write the events as JSON lines, read, parse, match."""
    root = scratch_path(spark, "lines")
    _json_lines(spark, sf_dir).select("value").write.text(root)
    records = _parse_nested(files.read_lines(spark, root))
    return _as_clicks(C.correlate(E.matchable(records, NESTED), NESTED, parsed_once=True))


TEXT_PATTERN = r"id=(\d+) user=(\S+) type=(\w+)(?: status=(\w+))?"


@query
def parse_regex(spark, sf_dir):
    """Unanchored search, an optional group, and lines that do not match."""
    records = I.click_records(spark, sf_dir)
    text = F.concat(
        F.lit("at "), _instant(), F.lit(" id="), F.col("event_id").cast("string"), F.lit(" user="), "user_id",
        F.lit(" type="), "event_type",
        F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(" status="), "status")).otherwise(F.lit(" -")),
    )
    value = F.when(F.col("event_id") % 5 == 0, F.lit("unrelated")).otherwise(text).alias("value")
    lines = once(records, [value]).select("value")
    groups = {"event_id": 1, "user_id": 2, "event_type": 3, "status": 4}
    return P.parse_regex(lines, TEXT_PATTERN, groups).drop("value")


@query
def parse_regex_correlate(spark, sf_dir):
    records = I.click_records(spark, sf_dir)
    text = F.concat_ws(
        " ", _instant(), F.concat(F.lit("id="), F.col("event_id")), "user_id", "event_type", "channel", "status"
    )
    groups = {"ts": 1, "event_id": 2, "user_id": 3, "event_type": 4, "channel": 5, "status": 6}
    pattern = r"(\S+) id=(\S+) (\S+) (\S+) (\S+) (\S+)"
    parsed = P.parse_regex(once(records, [text.alias("value")]).select("value"), pattern, groups)
    parsed = parsed.withColumn("event_id", F.col("event_id").cast("bigint"))
    return C.correlate(E.matchable(parsed, I.CLICKS), I.CLICKS, parsed_once=True)


def _block_text(spark, sf_dir):
    """The events as payment message blocks; field 127 holds the event id."""
    records = I.click_records(spark, sf_dir)
    view, sold = F.col("event_type") == "view", F.col("event_type") == "purchase"

    def line(number, value):
        return F.concat(F.lit(f"Field {number}: "), value)

    text = F.concat_ws(
        "\n\n",
        F.concat(
            F.lit("Pid: "), (F.col("event_id") % 1000).cast("string"),
            F.when(view, F.lit(" Received At: ")).otherwise(F.lit(" Sent At: ")),
            F.date_format("ts", P.BLOCK_TIME_FORMAT),
        ),
        F.concat(F.lit("MessageId: "), F.when(view, "1200").when(sold, "1210").otherwise("1804")),
        line("002", F.concat(F.lit("4000"), F.lpad("user_id", 12, "0"))),
        line("011", F.lpad("user_id", 6, "0")),
        F.when(sold, line("039", F.col("status"))),
        F.when(view, line("123", F.lit("first"))),
        F.when(view, line("123", F.col("channel"))),
        line("127", F.col("event_id").cast("string")),
    )
    return once(records, [text.alias("value")]).select("event_id", "value")


def _parsed_blocks(blocks):
    parsed = P.parse_payment_block(blocks.select("value"), all_fields=True)
    return parsed.select(
        F.element_at("fields", F.lit("127")).cast("bigint").alias("event_id"),
        "pid", "message_id", "ts", "pan", "stan", "channel", "response_code",
    )


@query
def parse_blocks(spark, sf_dir):
    return _parsed_blocks(_block_text(spark, sf_dir))


def _block_files(spark, sf_dir, separator):
    root = scratch_path(spark, "blocks")
    ended = F.concat("value", F.lit("\n\n" + separator + "\n\n" + separator))
    _block_text(spark, sf_dir).select(ended.alias("value")).write.text(root)
    return root


@query
def read_blocks(spark, sf_dir):
    """Files cut into small byte ranges."""
    root = _block_files(spark, sf_dir, "<" + "=" * 73 + ">")
    return _parsed_blocks(files.read_blocks(spark, root, split_bytes=50_000))


@query
def stream_blocks(spark, sf_dir):
    """Three deliveries of block files, followed by a stream with a restart after each."""
    root = scratch_path(spark, "block-stream")
    text = _block_text(spark, sf_dir)
    ended = F.concat("value", F.lit("\n\n<=====>"))
    for part in range(3):
        text.filter(F.col("event_id") % 3 == part).select(ended.alias("value")).write.mode("append").text(f"{root}/in")
        blocks = files.stream_growing(spark, f"{root}/in", split_bytes=50_000)
        writer = blocks.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/progress")
        writer.trigger(availableNow=True).start().awaitTermination()
    return _parsed_blocks(spark.read.schema("source string, offset bigint, value string").parquet(f"{root}/out"))


@query
def read_blocks_whole_files(spark, sf_dir):
    root = _block_files(spark, sf_dir, "  <=====>\t")
    return _parsed_blocks(files.read_blocks_whole_files(spark, root))


@query
def read_blocks_legacy(spark, sf_dir):
    root = _block_files(spark, sf_dir, files.LEGACY_SEPARATOR)
    return _parsed_blocks(files.read_blocks_legacy(spark, root))


@query
def normalise_payment(spark, sf_dir):
    blocks = P.parse_payment_block(_block_text(spark, sf_dir))
    return P.normalise_payment(blocks).select(
        "event_id", "correlation_key", "direction", F.col("timestamp").alias("event_ts"), "message_id", "channel",
        "response_code",
    )


@query
def read_blocks_correlate(spark, sf_dir):
    """Blocks with the click fields, read from files, parsed and matched."""
    root = scratch_path(spark, "blocks")
    records = I.click_records(spark, sf_dir)
    text = F.concat_ws(
        "\n", _instant(), F.concat(F.lit("id="), F.col("event_id")), "user_id", "event_type", "channel", "status",
        F.lit("<=====>"),
    )
    records.select(text.alias("value")).write.text(root)
    groups = {"ts": 1, "event_id": 2, "user_id": 3, "event_type": 4, "channel": 5, "status": 6}
    pattern = r"(\S+)\nid=(\S+)\n(\S+)\n(\S+)\n(\S+)\n(\S+)"
    parsed = P.parse_regex(files.read_blocks(spark, root, split_bytes=50_000), pattern, groups)
    parsed = parsed.withColumn("event_id", F.col("event_id").cast("bigint"))
    return C.correlate(E.matchable(parsed, I.CLICKS), I.CLICKS, parsed_once=True)


@query
def mask_pan_text(spark, sf_dir):
    events = I.table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    return events.select(
        "event_id",
        mask_pan(F.concat(F.lit("4000"), F.lpad(user, 12, "0"))).alias("masked"),
        mask_pan(user).alias("masked_short"),
    )


@query
def hashed_key(spark, sf_dir):
    user = F.col("user_id").cast("string")
    return I.table(spark, sf_dir, "events").select("event_id", hash_key(user, F.col("event_type")).alias("hashed"))


@query
def instant_texts(spark, sf_dir):
    """Valid instants with and without fraction; two malformed shapes give NULL."""
    events = I.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kind == 1, F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("789z")))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format("ts", "'2026-02-30T'HH:mm:ss'Z'"))
    )
    return events.select("event_id", strict_instant(text).alias("instant"))


@query
def reject_malformed(spark, sf_dir):
    """Good and quarantined records by reason; blank records are neither."""
    kind = F.col("event_id") % 10
    spoiled = (
        F.when(kind == 0, F.concat("value", F.lit(" trailing")))
        .when(kind == 1, F.regexp_replace("value", '"user_id"', '"other"'))
        .when(kind == 2, F.regexp_replace("value", r'"ts":"[^"]*"', '"ts":"yesterday"'))
        .when(kind == 3, F.lit("  \t "))
        .otherwise(F.col("value"))
    )
    lines = once(_json_lines(spark, sf_dir), [spoiled.alias("text")]).select(F.col("text").alias("value"))
    parsed = P.parse_json_fields(P.not_blank(lines), NESTED.source_fields)
    good, bad = tables.quarantine_records(parsed, NESTED)
    number = F.regexp_extract("value", '"event_id":([0-9]+)', 1).cast("bigint").alias("event_id")
    return good.select(F.lit("good").alias("reason"), number).unionByName(bad.select("reason", number))


@query
def transaction_time(spark, sf_dir):
    """Date field and time field together, or the message time where they do not fit."""
    even = F.col("event_id") % 2 == 0
    blocks = once(
        I.table(spark, sf_dir, "events").select("event_id", "ts"),
        [F.concat(
            F.lit("Received At: "), F.date_format("ts", P.BLOCK_TIME_FORMAT), F.lit("\nField 017: "),
            F.date_format("ts", "yyyyMMdd"), F.lit("\nField 012: "),
            F.when(even, F.date_format("ts", "HHmmss")).otherwise(F.date_format("ts", "yyyyMMddHHmmss")),
        ).alias("value")],
    ).select("event_id", "value")
    return P.parse_payment_block(blocks).select("event_id", P.transaction_time().alias("transaction_ts"))


@query
def read_multi_source(spark, sf_dir):
    """Several inputs, one of them missing; the file path tells the server."""
    root = scratch_path(spark, "servers")
    part = F.concat(F.lit("part-"), (F.col("event_id") % 4).cast("string"))
    _json_lines(spark, sf_dir).select(part.alias("server"), "value").write.partitionBy("server").text(root)
    inputs = [f"{root}/server=part-{i}" for i in range(5)]
    lines = files.read_lines(spark, inputs, glob="*.txt")
    server = F.regexp_extract("source", r"server=([^/]+)/", 1).alias("server")
    return lines.select(server, F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))


@query
def ingest_changed(spark, sf_dir):
    """A second run over the same files plus a new one reads the new one only."""
    root = scratch_path(spark, "changed")
    lines = _json_lines(spark, sf_dir).withColumn("part", F.col("event_id") % 3)
    bp = NESTED

    def read(paths):
        return _parse_nested(files.read_lines(spark, paths)).drop("event_id")

    inputs = [f"{root}/in/part={i}" for i in range(3)]
    lines.filter("part < 2").select("part", "value").write.partitionBy("part").text(f"{root}/in")
    tables.ingest_changed(spark, bp, root, inputs, read)
    lines.filter("part = 2").select("part", "value").write.mode("append").partitionBy("part").text(f"{root}/in")
    tables.ingest_changed(spark, bp, root, inputs, read)
    stored = tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(bp))
    return stored.select("batch_id", "correlation_key", "event_type", "event_ts")


# -- streams ---------------------------------------------------------------------------------------


def _landed_in_order(df, time, root, parts=3):
    """Write `df` as `parts` successive deliveries by time."""
    low, high = df.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    step = (high - low) // parts + 1
    for i in range(parts):
        piece = (F.unix_micros(time) - low >= i * step) & (F.unix_micros(time) - low < (i + 1) * step)
        df.filter(piece).write.mode("append").parquet(root)


@query
def stream_correlate(spark, sf_dir):
    """What has been delivered in three parts, taken at once and matched with carry-over tables.

    One delivery per trigger would let a second pass match requests that were shadowed before; see
    `stream_late_data` for two batches and the tests for the passes.
    """
    root = scratch_path(spark, "stream")
    records = I.click_records(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    _landed_in_order(records, "ts", f"{root}/in")
    arriving = spark.readStream.schema(records.schema).parquet(f"{root}/in")
    S.tail(arriving, I.CLICKS, root, mode="batch").awaitTermination()
    pairs = tables.read_batches(spark, f"{root}/pairs", tables.pair_schema(I.CLICKS)).drop("batch_id")
    return _original_ids(pairs, records)


def _original_ids(pairs, records):
    """Stored events have new ids; put the table's own back for comparison."""
    own = records.select(
        F.col("event_id"), F.col("user_id").alias("correlation_key"), F.col("ts"), "event_type"
    )
    asked = own.filter("event_type = 'view'").select("correlation_key", F.col("ts").alias("request_ts"), F.col("event_id").alias("q"))
    sold = own.filter("event_type = 'purchase'").select("correlation_key", F.col("ts").alias("response_ts"), F.col("event_id").alias("p"))
    joined = pairs.join(asked, ["correlation_key", "request_ts"]).join(sold, ["correlation_key", "response_ts"])
    return (
        joined.withColumn("request_id", F.col("q")).withColumn("response_id", F.col("p")).withColumn("pair_id", F.col("p"))
        .select(*pairs.columns)
    )


@query
def stream_late_data(spark, sf_dir):
    """All responses arrive before any request; nothing expires, so every pair is found."""
    root = scratch_path(spark, "late")
    records = I.click_records(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    for wanted in (F.col("event_type") == "purchase", F.col("event_type") != "purchase"):
        records.filter(wanted).write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(records.schema).parquet(f"{root}/in")
        S.tail(arriving, I.CLICKS, root, mode="batch").awaitTermination()
    pairs = tables.read_batches(spark, f"{root}/pairs", tables.pair_schema(I.CLICKS)).drop("batch_id")
    return _original_ids(pairs, records)


STATE_LATENESS = timedelta(hours=12)


def _matched_in_state(spark, sf_dir):
    """Rows of the keyed matcher for three runs: an out-of-order delivery, a second one, the end of input.

    Events change places by up to twelve hours, also across deliveries, and every run is a restart.
    """
    root = scratch_path(spark, "state")
    records = I.click_records(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    low, high = records.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    shift = F.pmod(F.xxhash64("event_id"), F.lit(STATE_LATENESS // timedelta(microseconds=1)))
    first = F.unix_micros("ts") + shift < (low + high) // 2
    after_all = timedelta(microseconds=high + 1) + I.CLICKS.timeout + STATE_LATENESS
    end = I.end_of_input(records, I.CLICKS, after_all // timedelta(microseconds=1))
    for part in (records.filter(first), records.filter(~first), end):
        part.write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(records.schema).parquet(f"{root}/in")
        events = E.matchable(arriving, I.CLICKS)
        K.tail_in_state(events, I.CLICKS, root, STATE_LATENESS, mode="batch").awaitTermination()
    return K.stored_matches(spark, events, I.CLICKS, root)


@query
def stream_state_correlate(spark, sf_dir):
    """Pairs from keyed streaming state with event-time timers: those of one batch pass."""
    return K.matched_pairs(_matched_in_state(spark, sf_dir), I.CLICKS)


@query
def stream_state_given_up(spark, sf_dir):
    """Requests that timers gave up or that another request shadowed: all requests without a pair."""
    return K.given_up(_matched_in_state(spark, sf_dir)).select(*EVENT_VIEW)


@query
def stream_event_dedup(spark, sf_dir):
    """Two deliveries and a replay of both, through dedup state bounded by the watermark."""
    root = scratch_path(spark, "stream-dedup")
    records = I.click_records(spark, sf_dir).drop("event_id").withColumn("ts", F.col("ts").cast("timestamp"))
    copies = records.unionByName(records)
    for _ in range(2):
        copies.write.mode("append").parquet(f"{root}/in")
        arriving = spark.readStream.schema(records.schema).parquet(f"{root}/in")
        events = E.normalise(arriving, I.CLICKS, payload=True)
        S.store_stream(events, I.CLICKS, root, timedelta(days=40), mode="batch").awaitTermination()
    stored = tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(I.CLICKS))
    return stored.select("correlation_key", "event_type", "event_ts", "status")


@query
def stream_expire_pending(spark, sf_dir):
    """Requests given up because the newest event is past their timeout."""
    root = scratch_path(spark, "expire")
    bp = replace(I.CLICKS, timeout=timedelta(hours=6))
    records = I.click_records(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    records.write.parquet(f"{root}/in")
    arriving = spark.readStream.schema(records.schema).parquet(f"{root}/in")
    S.tail(arriving, bp, root, mode="batch", lateness=timedelta(0)).awaitTermination()
    expired = tables.read_batches(spark, f"{root}/expired", tables.event_schema(bp))
    return expired.select("correlation_key", "event_ts")


def _pair_batches(spark, sf_dir, root, batches):
    """Pairs written as batches 0, 1, ...; `batches` are conditions."""
    pairs = _with_stored_ids(_click_pairs(spark, sf_dir))
    names = tables.T.StructType.fromDDL(tables.pair_schema(I.CLICKS)).names
    pairs = cut_lineage(pairs.select(*names))
    for batch, wanted in enumerate(batches):
        tables.write_batch(pairs.filter(wanted), f"{root}/pairs", batch)


@query
def stream_bucket_metrics(spark, sf_dir):
    """Pairs of three batches that overlap in time; nothing is late within forty days."""
    root = scratch_path(spark, "tumbling")
    third = F.col("response_id.row") % 3
    _pair_batches(spark, sf_dir, root, [third == i for i in range(3)])
    S.tumbling_metrics(spark, I.CLICKS, root, timedelta(days=40), mode="batch")
    return S.stored_buckets(spark, I.CLICKS, root).drop("late")


@query
def stream_late_pairs(spark, sf_dir):
    """The second batch comes after the first one's buckets were closed: late pairs give rows of their own."""
    root = scratch_path(spark, "late-pairs")
    even = F.col("response_id.row") % 2 == 0
    _pair_batches(spark, sf_dir, root, [even])
    S.tumbling_metrics(spark, I.CLICKS, root, mode="batch")
    _pair_batches(spark, sf_dir, root, [even, ~even])
    S.tumbling_metrics(spark, I.CLICKS, root, mode="batch")
    return S.stored_buckets(spark, I.CLICKS, root)


@query
def export_poll(spark, sf_dir):
    """Three polls, a batch of pairs before each. Two deliveries fail, and one run crashes after its delivery:
    the receiver keeps what came last under a number, so each pair counts once."""
    root = scratch_path(spark, "poll")
    trouble = ["before", "before", "after"]

    def deliver(buckets, number):
        if trouble and trouble[-1 if number else 0] == "before":
            trouble.pop(0)
            raise IOError("503")
        tables.write_batch(buckets, f"{root}/delivered", number)
        if trouble and number:
            raise IOError(trouble.pop())

    third = F.col("response_id.row") % 3
    for batch in range(3):
        _pair_batches(spark, sf_dir, root, [third == i for i in range(batch + 1)])
        X.export_poll(spark, I.CLICKS, root, deliver, polls=1, wait=lambda seconds: None)
    return spark.read.parquet(f"{root}/delivered").withColumnRenamed("batch_id", "batch").withColumn("batch", F.col("batch").cast("bigint"))


@query
def ingest_identity(spark, sf_dir):
    """Records that differ only in a field the blueprint does not name are events of their own;
    the whole record is kept. Everything is delivered twice, in two batches."""
    root = scratch_path(spark, "identity")
    records = I.click_records(spark, sf_dir).drop("event_id")
    paid = records.withColumn("amount", F.explode(F.array(F.lit("1.50"), F.lit("2.5"), F.lit("1.50"))))
    for batch in range(2):
        tables.store_events(E.normalise(paid, I.CLICKS, payload=True), I.CLICKS, root, batch)
    stored = tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(I.CLICKS))
    return stored.select(
        "correlation_key", "event_type", "event_ts", F.get_json_object("payload", "$.amount").alias("amount"),
        F.get_json_object("payload", "$.status").alias("status"),
    )


@query
def export_drain(spark, sf_dir):
    """Exports of at most 200 pairs until nothing is left; the first two deliveries fail."""
    root = scratch_path(spark, "drain")
    tables.write_batch(_with_stored_ids(_click_pairs(spark, sf_dir)), f"{root}/pairs", 0)
    failures = [IOError("503"), IOError("503")]

    def deliver(buckets):
        if failures:
            raise failures.pop()

    total = tables.drain_exports(spark, I.CLICKS, root, deliver, limit=200)
    done = tables.read_batches(spark, f"{root}/exports", f"pair_id {tables.EVENT_ID}, exported_at timestamp")
    return done.groupBy("batch_id").agg(F.count("*").alias("pairs"), F.lit(total).cast("bigint").alias("total"))


# -- the older report set ------------------------------------------------------------------------


@query
def correlate_legacy(spark, sf_dir):
    return _done(spark, sf_dir)


@query
def correlate_legacy_hot_keys(spark, sf_dir):
    return _done(spark, sf_dir, hot_rows=20, per_segment=500)


@query
def transactions(spark, sf_dir):
    return _transactions(spark, sf_dir)


@query
def transactions_hot_keys(spark, sf_dir):
    messages = _messages(spark, sf_dir)
    return L.transaction_table(messages, as_of(), I.TIMEOUT_MINUTES, hot_rows=20, per_segment=500)


@query
def timeout_transactions(spark, sf_dir):
    return L.timeout_transactions(L.waiting_requests(_messages(spark, sf_dir)), as_of(), I.TIMEOUT_MINUTES)


@query
def pending_count(spark, sf_dir):
    return R.total_count(L.waiting_requests(_messages(spark, sf_dir)), "pending")


@query
def total_count(spark, sf_dir):
    return R.total_count(_transactions(spark, sf_dir))


def _legacy_ledger(done):
    return L.exported_keys(done.filter(F.col("is_valid") & (F.col("stan").cast("bigint") % 3 == 0)))


@query
def scan_legacy_unexported(spark, sf_dir):
    done = _done(spark, sf_dir).select(*L.TRANSACTION_COLUMNS)
    return L.unexported_transactions(done, _legacy_ledger(done)).select(*L.TRANSACTION_COLUMNS)


@query
def scan_legacy_unexported_limit(spark, sf_dir):
    """The first 20 open rows by id: the batch limit is the operator."""
    done = _done(spark, sf_dir).select(*L.TRANSACTION_COLUMNS)
    return L.unexported_transactions(done, _legacy_ledger(done), limit=20).select(*L.TRANSACTION_COLUMNS)


@query
def legacy_export_cycle(spark, sf_dir):
    """Transactions stored in two batches, the first one twice, then exported; one delivery fails.
    What was delivered."""
    root = scratch_path(spark, "transactions")
    done = cut_lineage(_done(spark, sf_dir).select(*L.TRANSACTION_COLUMNS))
    for batch, part in ((0, 0), (0, 0), (1, 1)):
        tables.store_transactions(done.filter(F.pmod(F.xxhash64("correlation_key"), F.lit(2)) == part), root, batch)
    failures = [IOError("503")]

    def deliver(rows):
        if failures:
            raise failures.pop()
        rows.write.mode("append").parquet(f"{root}/delivered")

    tables.drain(lambda: tables.export_transactions_once(spark, root, deliver, id_type="bigint"))
    return spark.read.schema(done.schema).parquet(f"{root}/delivered")


@query
def transaction_lines(spark, sf_dir):
    """The line file, read back."""
    path = scratch_path(spark, "lines")
    tables.write_transaction_lines(_done(spark, sf_dir), path)
    schema = "tat_ms bigint, stan string, channel string, response_code string, timestamp bigint, status string"
    return spark.read.schema(schema).json(path)


@query
def legacy_status(spark, sf_dir):
    return _transactions(spark, sf_dir).select("pair_id", L.status(F.col("tat_millis")).alias("status"))


@query
def mti_filter(spark, sf_dir):
    return L.mti_filter(I.card_messages(spark, sf_dir)).select("event_id", "message_id")


@query
def legacy_defaults(spark, sf_dir):
    """A request without channel and a response without code."""
    messages = _messages(spark, sf_dir).withColumns(
        {
            "channel": F.when(F.col("channel") != "ch1", F.col("channel")),
            "response_code": F.when(F.col("response_code") != "500", F.col("response_code")),
        }
    )
    return L.correlate_legacy(messages).select("pair_id", "channel", "response_code")


@query
def write_report(spark, sf_dir):
    """The sections of the written report, read back as (section, name, measure, value)."""
    path = scratch_path(spark, "report")
    tables.write_report(_done(spark, sf_dir), path, at_ms())
    gauge = "metric_name string, metric_type string"
    whole, real = (lambda names: [(n, "bigint") for n in names]), (lambda names: [(n, "double") for n in names])
    sections = {
        "transaction_level_metrics": ("transaction_id", gauge + ", transaction_id string", whole(["value", "timestamp_ms"])),
        "channel_level_metrics": ("channel", gauge + ", channel string", whole(["count", "sum_ms"]) + real(["avg_ms", "min_ms", "max_ms"])),
        "response_code_metrics": ("response_code", gauge + ", response_code string", whole(["count"]) + real(["avg_ms", "min_ms", "max_ms", "p95_ms", "p99_ms"])),
        "summary_stats": (None, "timestamp_ms bigint", whole(["total_transactions", "success_count"]) + real(["avg_tat_ms", "p50_ms", "p99_ms", "success_rate_pct"])),
    }
    rows = None
    for section, (name, head, measures) in sections.items():
        schema = head + "".join(f", {m} {kind}" for m, kind in measures)
        each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m, _ in measures])
        read = spark.read.schema(schema).json(f"{path}/{section}")
        part = read.select(F.lit(section).alias("section"), (F.col(name) if name else F.lit(section)).alias("name"), F.inline(each))
        rows = part if rows is None else rows.unionByName(part)
    return rows


@query
def write_documents(spark, sf_dir):
    """The export documents, written and read back: the metrics of each."""
    path = scratch_path(spark, "documents")
    tables.write_documents(_click_buckets(spark, sf_dir), I.CLICKS, path)
    shape = "array<struct<name:string,sum:struct<dataPoints:array<struct<asInt:string>>>>>"
    lines = files.read_lines(spark, path)
    metrics = F.from_json(F.get_json_object("value", "$.resourceMetrics[0].scopeMetrics[0].metrics"), shape)
    return lines.select(F.inline(metrics)).select("name", F.size("sum.dataPoints").alias("points"))


@query
def transaction_metrics(spark, sf_dir):
    return R.transaction_metrics(_done(spark, sf_dir), at_ms())


@query
def channel_metrics(spark, sf_dir):
    return R.channel_metrics(_done(spark, sf_dir), at_ms())


@query
def response_code_metrics(spark, sf_dir):
    return R.response_code_metrics(_done(spark, sf_dir), at_ms())


@query
def summary_stats(spark, sf_dir):
    return R.summary_stats(_done(spark, sf_dir), at_ms())


def _over(name, report, source):
    def run(spark, sf_dir):
        return report(source(spark, sf_dir))

    run.__name__ = name
    query(run)


for _name in ("channel_series", "series_points"):
    _over(_name, lambda tx, report=getattr(R, _name): report(tx, at_ms()), _done)

for _name in (
    "channel_report",
    "code_report",
    "match_report",
    "overall_report",
    "transaction_listing",
    "correlation_health",
    "latency_by_channel",
    "latency_by_code",
    "slow_transactions",
    "success_by_channel",
    "timeouts",
    "timeouts_by_channel",
    "outliers_sigma",
    "p95_rank",
    "window_stats",
):
    _over(_name, getattr(R, _name), _transactions)

_over("latency_trend", lambda tx: R.latency_trend(tx, 300), _transactions)
_over("success_trend", lambda tx: R.success_trend(tx, 300), _transactions)
_over("timeout_points", lambda tx: M.timeout_points(tx, 60), _transactions)
