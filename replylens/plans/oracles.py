"""The registered queries as plain SQL, written against the given tables."""

from __future__ import annotations

DAY_US = 86_400_000_000
HOUR_US = 3_600_000_000

CLICK_RECORDS = """
  SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, ts,
         'ch' || CAST(user_id % 5 AS VARCHAR) AS channel,
         CASE WHEN CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) % 4 = 0 THEN '500' ELSE '000' END AS status
  FROM events"""

CLICKS = f"""rec AS ({CLICK_RECORDS}),
ev AS (
  SELECT event_id, user_id AS correlation_key, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS ord,
         epoch_us(ts) AS us, ts, channel AS d1, CAST(NULL AS VARCHAR) AS d2, status
  FROM rec WHERE event_type IN ('view', 'purchase'))"""

SHIPMENTS = """ev AS (
  SELECT 'order-' || CAST(o_orderkey AS VARCHAR) AS event_id, CAST(o_orderkey AS VARCHAR) AS correlation_key, 0 AS ord,
         epoch_us(o_orderdate) AS us, o_orderdate AS ts, o_orderpriority AS d1,
         CAST(NULL AS VARCHAR) AS d2, CAST(NULL AS VARCHAR) AS status
  FROM orders
  UNION ALL
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')), CAST(l_orderkey AS VARCHAR), 1,
         epoch_us(l_shipdate), l_shipdate, NULL, l_returnflag, l_linestatus
  FROM lineitem)"""

TURNS = """ev AS (
  SELECT conv_id * 100000 + turn AS event_id, CAST(conv_id AS VARCHAR) AS correlation_key,
         CASE role WHEN 'user' THEN 0 ELSE 1 END AS ord, (1704067200 + turn) * 1000000 AS us,
         make_timestamp((1704067200 + turn) * 1000000) AS ts, CAST(NULL AS VARCHAR) AS d1,
         CAST(NULL AS VARCHAR) AS d2, CAST(NULL AS VARCHAR) AS status
  FROM conversations WHERE role IN ('user', 'assistant'))"""


def match(timeout_us, source="ev", tag="", success="'000'"):
    """Pairs by runs between responses and a fold over each run's requests."""
    return f"""runs{tag} AS (
  SELECT *, COALESCE(SUM(ord) OVER (PARTITION BY correlation_key ORDER BY us, ord, event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM {source}),
folded{tag} AS (
  SELECT correlation_key, run,
         list_reduce(list({{'us': us, 'id': event_id, 'ts': ts, 'd1': d1, 'd2': d2}} ORDER BY us, event_id)
                     FILTER (WHERE ord = 0),
                     lambda a, x: CASE WHEN x.us - a.us > {timeout_us} THEN x ELSE a END) AS q,
         any_value({{'us': us, 'id': event_id, 'ts': ts, 'd1': d1, 'd2': d2, 'status': status}})
                     FILTER (WHERE ord = 1) AS p
  FROM runs{tag} GROUP BY correlation_key, run),
pairs{tag} AS (
  SELECT p.id AS pair_id, correlation_key, q.id AS request_id, p.id AS response_id, q.ts AS request_ts,
         p.ts AS response_ts, CAST((p.us - q.us) // 1000 AS BIGINT) AS latency_ms,
         CASE WHEN p.status IS NULL THEN 'UNKNOWN' WHEN p.status = {success} THEN 'SUCCESS' ELSE 'ERROR' END AS outcome,
         COALESCE(p.d1, q.d1) AS d1, COALESCE(p.d2, q.d2) AS d2
  FROM folded{tag} WHERE p IS NOT NULL AND q IS NOT NULL AND p.us - q.us <= {timeout_us})"""


CLICK_PAIRS = f"{CLICKS},\n{match(48 * HOUR_US)}"
SHIPMENT_PAIRS = f"{SHIPMENTS},\n{match(365 * DAY_US, success=chr(39) + 'F' + chr(39))}"
TURN_PAIRS = f"{TURNS},\n{match(1_000_000)}"

PAIR_COLUMNS = (
    "pair_id, correlation_key, request_id, response_id, request_ts, response_ts, latency_ms, outcome"
)


def select_pairs(blueprint, dims, source="pairs"):
    names = "".join(f", {src} AS {name}" for src, name in dims)
    return f"SELECT '{blueprint}' AS blueprint, {PAIR_COLUMNS}{names} FROM {source}"


def rank(q, value="latency_ms"):
    """Nearest rank: the ceil(q * n)-th smallest value."""
    return f"list_sort(list({value}))[CAST(greatest(1, ceil(CAST({q} AS DOUBLE) * count(*))) AS BIGINT)]"


def floor_rank(percent, value="tat_millis"):
    return f"list_sort(list({value}))[CAST(floor(CAST({percent / 100.0!r} AS DOUBLE) * count(*)) AS BIGINT) + 1]"


def bucket(ts, seconds):
    return f"make_timestamp(CAST(epoch_us({ts}) // {seconds * 1_000_000} * {seconds * 1_000_000} AS BIGINT))"


def buckets(seconds, dims, source="pairs", extra=""):
    names = "".join(f", {src} AS {name}" for src, name in dims)
    keys = "".join(f", {src}" for src, _ in dims)
    more = f", {extra}" if extra else ""
    ok, bad = "count(*) FILTER (WHERE outcome = 'SUCCESS')", "count(*) FILTER (WHERE outcome = 'ERROR')"
    return f"""SELECT {bucket('response_ts', seconds)} AS bucket_start, CAST({seconds} AS BIGINT) AS bucket_seconds{more}{names},
  count(*) AS count, {ok} AS success_count, {bad} AS error_count,
  min(latency_ms) AS min_latency_ms, max(latency_ms) AS max_latency_ms,
  CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms,
  {rank(0.95)} AS p95_latency_ms, {rank(0.99)} AS p99_latency_ms,
  CASE WHEN {ok} + {bad} = 0 THEN 0.0::DOUBLE ELSE CAST({ok} AS DOUBLE) / ({ok} + {bad}) END AS success_rate,
  CASE WHEN {ok} + {bad} = 0 THEN 0.0::DOUBLE ELSE CAST({bad} AS DOUBLE) / ({ok} + {bad}) END AS error_rate,
  CAST(count(*) AS DOUBLE) / {float(seconds)}::DOUBLE AS throughput
FROM {source} GROUP BY {bucket('response_ts', seconds)}{keys}{more}"""


CLICK_DIMS = [("d1", "channel")]
SHIPMENT_DIMS = [("d1", "priority"), ("d2", "returnflag")]
CLICK_BUCKETS = f"{CLICK_PAIRS},\nbuckets AS ({buckets(86400, CLICK_DIMS)})"

# -- the older report set -----------------------------------------------------------------

CARD = f"""rec AS ({CLICK_RECORDS}),
card AS (
  SELECT (event_id + (event_id * 7919) % 23) * 1000000000 + event_id AS event_id,
         '4000' || lpad(user_id, 8, '0') || '|' || user_id AS correlation_key,
         CASE event_type WHEN 'view' THEN 0 WHEN 'purchase' THEN 1 END AS ord,
         CAST(1704067200000000 + (epoch_us(ts) - 1704067200000000) // 1000 AS BIGINT) AS us,
         user_id AS stan, '4000' || lpad(user_id, 8, '0') AS pan, channel,
         CASE event_type WHEN 'purchase' THEN status END AS response_code
  FROM rec),
mti AS (SELECT * FROM card WHERE ord IS NOT NULL),
lruns AS (
  SELECT *, COALESCE(SUM(ord) OVER (PARTITION BY correlation_key ORDER BY event_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM mti),
lfolded AS (
  SELECT correlation_key, run,
         arg_min({{'us': us, 'id': event_id, 'stan': stan, 'pan': pan, 'channel': channel}}, event_id)
                 FILTER (WHERE ord = 0) AS q,
         any_value({{'us': us, 'id': event_id, 'code': response_code}}) FILTER (WHERE ord = 1) AS p
  FROM lruns GROUP BY correlation_key, run),
done AS (
  SELECT p.id AS pair_id, correlation_key, q.stan AS stan, q.pan AS pan, COALESCE(q.channel, 'UNKNOWN') AS channel,
         CAST(trunc((p.us - q.us) / 1000.0) AS BIGINT) AS tat_millis, COALESCE(p.code, 'PENDING') AS response_code,
         CAST(trunc((p.us - q.us) / 1000.0) AS BIGINT) BETWEEN 1 AND 60000 AS is_valid,
         make_timestamp(p.us) AS completed_at, q.id AS request_id, p.id AS response_id
  FROM lfolded WHERE p IS NOT NULL AND q IS NOT NULL),
waiting AS (SELECT correlation_key, q FROM lfolded WHERE p IS NULL AND q IS NOT NULL),
late AS (
  SELECT q.id AS pair_id, correlation_key, q.stan AS stan, q.pan AS pan, COALESCE(q.channel, 'UNKNOWN') AS channel,
         CAST(-1 AS BIGINT) AS tat_millis, 'TIMEOUT' AS response_code, FALSE AS is_valid,
         TIMESTAMP '2024-01-01 00:45:00' AS completed_at
  FROM waiting
  WHERE epoch_us(TIMESTAMP '2024-01-01 00:45:00') - q.us > 2 * 60 * 1000000),
tx AS (
  SELECT pair_id, correlation_key, stan, pan, channel, tat_millis, response_code, is_valid, completed_at FROM done
  UNION ALL SELECT * FROM late)"""

TX_COLUMNS = "pair_id, correlation_key, stan, pan, channel, tat_millis, response_code, is_valid, completed_at"


def mean(value="tat_millis"):
    return f"CAST(sum({value}) AS DOUBLE) / count(*)"


def half_up(value):
    return f"floor({value} + 0.5::DOUBLE)"


def with_(ctes, body):
    return f"WITH {ctes}\n{body}"


AT_MS = "CAST(1704069900000 AS BIGINT)"


def melted(section, name, measures, source):
    """(section, name, measure, value) of a report section."""
    names = ", ".join(f"'{m}'" for m in measures)
    values = ", ".join(f"CAST({m} AS DOUBLE)" for m in measures)
    return f"SELECT '{section}' AS section, {name} AS name, unnest([{names}]) AS measure, unnest([{values}]) AS value FROM ({source})"


def channel_series(source):
    def one(figure, expr):
        return (
            f"SELECT 'payment.channel.tat.{figure}' AS series_id, channel, CAST(NULL AS VARCHAR) AS response_code, "
            f"{AT_MS} AS timestamp_ms, CAST({expr} AS DOUBLE) AS value FROM {source} GROUP BY channel"
        )

    percent = "CAST(count(*) FILTER (WHERE response_code = '000') AS DOUBLE) / count(*) * 100"
    overall = (
        f"SELECT 'payment.success.rate', NULL, NULL, {AT_MS}, {half_up(f'{percent} * 100')} / 100.0::DOUBLE FROM {source}"
    )
    parts = [one("avg", half_up(mean())), one("min", "min(tat_millis)"), one("max", "max(tat_millis)")]
    return "\nUNION ALL ".join([*parts, one("count", "count(*)"), overall])


def points():
    """Every bucket times every metric of the click blueprint."""
    spec = [
        ("latency", "HISTOGRAM", None),
        ("count", "COUNTER", "count"),
        ("errors", "COUNTER", "error_count"),
        ("successes", "COUNTER", "success_count"),
        ("latency.now", "GAUGE", "avg_latency_ms"),
        ("latency.avg", "GAUGE", "avg_latency_ms"),
        ("latency.min", "GAUGE", "min_latency_ms"),
        ("latency.max", "GAUGE", "max_latency_ms"),
        ("latency.p95", "GAUGE", "p95_latency_ms"),
        ("latency.p99", "GAUGE", "p99_latency_ms"),
        ("success_rate", "RATE", "success_rate"),
        ("error_rate", "RATE", "error_rate"),
        ("throughput", "RATE", "throughput"),
    ]
    parts = []
    for name, kind, column in spec:
        histogram, counter = kind == "HISTOGRAM", kind == "COUNTER"
        none_long, none_double = "CAST(NULL AS BIGINT)", "CAST(NULL AS DOUBLE)"
        parts.append(
            f"""SELECT epoch_us(bucket_start) * 1000 AS start_ns,
  epoch_us(bucket_start) * 1000 + bucket_seconds * 1000000000 AS end_ns, channel,
  'replylens.{name}' AS metric, '{kind}' AS type,
  {'count' if histogram else none_long} AS point_count,
  {'avg_latency_ms * count' if histogram else none_double} AS point_sum,
  {f'CAST({column} AS BIGINT)' if counter else none_long} AS as_int,
  {none_double if histogram or counter else f'CAST({column} AS DOUBLE)'} AS as_double FROM buckets"""
        )
    return "\nUNION ALL ".join(parts)


def percentiles(groups, percents, source):
    keys = ", ".join(groups)
    ranks = ", ".join(f"{rank(p / 100, 'tat_millis')} AS p{p}" for p in percents)
    return f"SELECT {keys}, count(*) AS cnt, {mean()} AS avg_tat, {ranks} FROM {source} GROUP BY {keys}"


LEFTOVER = "ev WHERE event_id NOT IN (SELECT request_id FROM pairs UNION ALL SELECT response_id FROM pairs)"
SECOND_PASS = f"{CLICK_PAIRS},\nleft1 AS (SELECT * FROM {LEFTOVER}),\n{match(48 * HOUR_US, 'left1', '2')}"


def oracles() -> dict:
    sql = {}
    click_pairs = select_pairs("clicks", CLICK_DIMS)
    for name in (
        "correlate",
        "correlate_hot_keys",
        "read_json_lines_correlate",
        "read_blocks_correlate",
        "parse_regex_correlate",
        "stream_correlate",
        "stream_late_data",
        "stream_state_correlate",
        "write_pairs",
        "pair_dedup",
        "event_dedup_correlate",
    ):
        sql[name] = with_(CLICK_PAIRS, click_pairs)
    sql["correlate_timeout_6h"] = with_(f"{CLICKS},\n{match(6 * HOUR_US)}", click_pairs)
    sql["correlate_carry_over"] = with_(
        SECOND_PASS, f"{click_pairs} UNION ALL {select_pairs('clicks', CLICK_DIMS, 'pairs2')}"
    )
    sql["event_classify"] = with_(
        f"rec AS ({CLICK_RECORDS})",
        "SELECT event_id, user_id AS correlation_key, event_type, "
        "CASE event_type WHEN 'view' THEN 'request' ELSE 'response' END AS role FROM rec "
        "WHERE event_type IN ('view', 'purchase')",
    )
    sql["scan_pending"] = with_(CLICK_PAIRS, f"SELECT event_id, correlation_key, ts AS event_ts FROM {LEFTOVER}")
    sql["unmatched_requests"] = with_(
        CLICK_PAIRS, f"SELECT event_id, correlation_key, ts AS event_ts FROM {LEFTOVER} AND ord = 0"
    )
    sql["stream_state_given_up"] = sql["unmatched_requests"]
    sql["orphan_responses"] = with_(
        CLICK_PAIRS, f"SELECT event_id, correlation_key, ts AS event_ts FROM {LEFTOVER} AND ord = 1"
    )
    sql["expired_requests"] = with_(
        CLICK_PAIRS,
        f"SELECT event_id, correlation_key, ts AS event_ts FROM {LEFTOVER} AND ord = 0 "
        "AND epoch_us(TIMESTAMP '2024-01-31 00:00:00') - us > 60 * 1000000",
    )
    sql["bucket_metrics"] = with_(CLICK_PAIRS, buckets(86400, CLICK_DIMS))
    sql["stream_bucket_metrics"] = sql["bucket_metrics_by_cell"] = sql["bucket_metrics"]
    # Even responses are closed up to the end of their last bucket before the odd ones arrive.
    late_buckets = buckets(86400, CLICK_DIMS, source="told", extra="late")
    sql["stream_late_pairs"] = with_(
        CLICK_PAIRS,
        f"""SELECT * FROM (WITH told AS (
          SELECT *, response_id % 2 = 1 AND {bucket('response_ts', 86400)} <=
            (SELECT max({bucket('response_ts', 86400)}) FROM pairs WHERE response_id % 2 = 0) AS late FROM pairs)
        {late_buckets})""",
    )
    sql["ingest_identity"] = f"""WITH rec AS ({CLICK_RECORDS})
        SELECT DISTINCT user_id AS correlation_key, event_type, ts AS event_ts, amount, status
        FROM rec, (VALUES ('1.50'), ('2.5')) AS v(amount)"""
    sql["export_drain"] = with_(
        CLICK_PAIRS,
        """SELECT CAST(g AS BIGINT) AS batch_id, count(*) AS pairs, CAST((SELECT count(*) FROM pairs) AS BIGINT) AS total
        FROM (SELECT (row_number() OVER (ORDER BY pair_id) - 1) // 200 AS g FROM pairs) GROUP BY g""",
    )
    exact = "bucket_start, bucket_seconds, channel, count, success_count, error_count, min_latency_ms, max_latency_ms, avg_latency_ms"
    sql["bucket_metrics_approximate"] = with_(
        CLICK_BUCKETS, f"SELECT {exact}, success_rate, error_rate, throughput, true AS within_error FROM buckets"
    )
    sql["cardinality_approximate"] = with_(
        CLICK_BUCKETS,
        "SELECT count(*) AS series, true AS within_error FROM (SELECT DISTINCT bucket_start, channel FROM buckets)",
    )
    sql["bucket_metrics_hourly"] = with_(
        f"{CLICKS},\n{match(HOUR_US)}", buckets(3600, CLICK_DIMS)
    )
    sql["bucket_metrics_per_batch"] = with_(
        CLICK_PAIRS, buckets(86400, CLICK_DIMS, extra="batch", source="(SELECT *, pair_id % 3 AS batch FROM pairs)")
    )
    sql["export_poll"] = sql["bucket_metrics_per_batch"]
    sql["bucket_time_fallback"] = with_(
        CLICK_PAIRS,
        f"SELECT {bucket('CASE WHEN pair_id % 2 = 0 THEN request_ts ELSE response_ts END', 86400)} AS bucket_start, "
        "count(*) AS count FROM pairs WHERE pair_id % 3 <> 0 GROUP BY 1",
    )
    sql["dimension_empty_as_null"] = with_(
        f"""rec AS ({CLICK_RECORDS}),
ev AS (
  SELECT event_id, user_id AS correlation_key, CASE event_type WHEN 'view' THEN 0 ELSE 1 END AS ord,
         epoch_us(ts) AS us, ts,
         CASE WHEN event_type = 'purchase' AND event_id % 2 = 0 THEN NULL ELSE channel END AS d1,
         CAST(NULL AS VARCHAR) AS d2, status
  FROM rec WHERE event_type IN ('view', 'purchase')),
{match(48 * HOUR_US)}""",
        click_pairs,
    )
    sql["dimension_empty_wins"] = sql["dimension_empty_as_null"].replace("THEN NULL ELSE channel", "THEN '' ELSE channel")
    sql["shipments_correlate"] = with_(SHIPMENT_PAIRS, select_pairs("shipments", SHIPMENT_DIMS))
    sql["shipments_bucket_metrics"] = with_(SHIPMENT_PAIRS, buckets(86400, SHIPMENT_DIMS))
    sql["shipments_match_rate"] = with_(
        SHIPMENT_PAIRS,
        "SELECT (SELECT count(*) FROM pairs) AS matched, "
        "(SELECT count(*) FROM ev WHERE ord = 0) - (SELECT count(*) FROM pairs) AS unmatched_requests, "
        "(SELECT count(*) FROM ev WHERE ord = 1) - (SELECT count(*) FROM pairs) AS orphan_responses",
    )
    sql["turns_correlate"] = with_(TURN_PAIRS, select_pairs("turns", []))
    sql["turns_bucket_metrics"] = with_(TURN_PAIRS, buckets(3600, []))
    sql["event_dedup"] = with_(
        f"rec AS ({CLICK_RECORDS})", "SELECT event_id, user_id AS correlation_key, event_type, ts AS event_ts, channel FROM rec"
    )
    sql["ingest_replay"] = with_(
        f"rec AS ({CLICK_RECORDS})",
        "SELECT user_id AS correlation_key, event_type, ts AS event_ts, channel, status FROM rec",
    )
    sql["stream_event_dedup"] = with_(
        f"rec AS ({CLICK_RECORDS})", "SELECT user_id AS correlation_key, event_type, ts AS event_ts, status FROM rec"
    )
    sql["scan_unexported"] = with_(
        CLICK_PAIRS, f"{click_pairs} WHERE pair_id % 3 <> 0 ORDER BY pair_id LIMIT 100"
    )
    sql["export_anti_join"] = with_(CLICK_PAIRS, f"{click_pairs} WHERE pair_id % 3 <> 0")
    sql["export_cycle"] = with_(CLICK_PAIRS, "SELECT count(*) AS first_run, CAST(0 AS BIGINT) AS second_run FROM pairs")

    sql["valid_events"] = (
        "SELECT event_id, ' ' || CAST(user_id AS VARCHAR) AS correlation_key, ts AS event_ts FROM events "
        "WHERE event_id % 7 <> 0 AND event_id % 11 <> 0"
    )
    sql["core_fields"] = (
        f"WITH {SHIPMENTS} SELECT event_id, correlation_key AS orderkey, CASE ord WHEN 0 THEN 'order' ELSE 'ship' END AS event_type "
        "FROM ev WHERE CAST(correlation_key AS BIGINT) % 5 <> 0 AND CAST(correlation_key AS BIGINT) % 7 <> 0 "
        "AND (ord = 0 OR CAST(correlation_key AS BIGINT) % 3 <> 0)"
    )
    sql["correlated_flags"] = with_(
        CLICK_PAIRS,
        "SELECT event_id, event_id IN (SELECT request_id FROM pairs UNION ALL SELECT response_id FROM pairs) AS correlated FROM ev",
    )
    sql["stream_expire_pending"] = with_(
        f"{CLICKS},\n{match(6 * HOUR_US)}",
        f"SELECT correlation_key, ts AS event_ts FROM {LEFTOVER} AND ord = 0 "
        f"AND us + {6 * HOUR_US} < (SELECT max(us) FROM ev)",
    )
    sql["granularity"] = with_(
        CLICK_PAIRS,
        "\nUNION ALL ".join(
            f"SELECT '{w}' AS width, {bucket('response_ts', n)} AS bucket_start, count(*) AS count FROM pairs GROUP BY 1, 2"
            for w, n in (("30s", 30), ("5m", 300), ("6h", 21600), ("2d", 172800))
        ),
    )
    sql["mti_filter"] = with_(
        CARD, "SELECT event_id, CASE ord WHEN 0 THEN '1200' ELSE '1210' END AS message_id FROM mti"
    )
    sql["legacy_defaults"] = with_(
        CARD,
        "SELECT pair_id, CASE channel WHEN 'ch1' THEN 'UNKNOWN' ELSE channel END AS channel, "
        "CASE response_code WHEN '500' THEN 'PENDING' ELSE response_code END AS response_code FROM done",
    )
    sql["write_documents"] = with_(
        CLICK_BUCKETS,
        "SELECT metric AS name, CASE WHEN type = 'COUNTER' THEN 1 END AS points FROM (" + points() + ")",
    )
    sql["metric_points"] = with_(CLICK_BUCKETS, points())
    sql["metric_documents"] = with_(
        CLICK_BUCKETS,
        "SELECT channel, metric, type, CAST(start_ns AS VARCHAR) AS start_ns, CAST(end_ns AS VARCHAR) AS end_ns, "
        f"CAST(coalesce(point_count, as_int) AS VARCHAR) AS whole, coalesce(point_sum, as_double) AS real FROM ({points()})",
    )
    sql["packed_documents"] = sql["metric_documents"]
    sql["rollup_sketches"] = with_(
        CLICK_PAIRS,
        "SELECT d1 AS channel, count(*) AS count, round(avg(latency_ms), 4) AS mean_ms, "
        "round(stddev_samp(latency_ms), 4) AS deviation_ms, true AS p95_within_error, true AS keys_within_error FROM pairs GROUP BY d1",
    )
    sql["histogram_points"] = with_(CLICK_BUCKETS, f"SELECT * FROM ({points()}) WHERE type = 'HISTOGRAM'")
    sql["counter_points"] = with_(CLICK_BUCKETS, f"SELECT * FROM ({points()}) WHERE type = 'COUNTER'")
    sql["gauge_points"] = with_(CLICK_BUCKETS, f"SELECT * FROM ({points()}) WHERE type IN ('GAUGE', 'RATE')")
    sql["rollup_channel"] = with_(
        CLICK_BUCKETS,
        "SELECT channel, round(avg(avg_latency_ms), 6) AS avg_of_avg, CAST(sum(count) AS BIGINT) AS total, "
        "max(p95_latency_ms) AS max_p95, max(p99_latency_ms) AS max_p99 FROM buckets GROUP BY channel",
    )
    sql["cardinality"] = with_(
        CLICK_BUCKETS, "SELECT count(*) AS series FROM (SELECT DISTINCT bucket_start, channel FROM buckets)"
    )
    by_code = buckets(86400, [("d1", "channel"), ("code", "response_code")], "coded")
    coded = f"{CLICK_PAIRS},\ncoded AS (SELECT pairs.*, ev.status AS code FROM pairs JOIN ev ON ev.event_id = response_id),\nbuckets AS ({by_code})"
    sql["rollup_code"] = with_(
        coded, "SELECT response_code, max(p95_latency_ms) AS max_p95 FROM buckets GROUP BY response_code"
    )
    sql["rollup_success"] = with_(
        coded,
        "SELECT CAST(sum(CASE WHEN response_code = '000' THEN count ELSE 0 END) AS DOUBLE) / sum(count) AS success_rate FROM buckets",
    )
    sql["rollup_by_server"] = with_(
        f"{CLICK_PAIRS},\nbuckets AS ({buckets(86400, CLICK_DIMS, extra='server', source='(SELECT *, ' + chr(39) + 'srv-' + chr(39) + ' || CAST(pair_id % 4 AS VARCHAR) AS server FROM pairs)')})",
        "SELECT server, channel, round(avg(avg_latency_ms), 6) AS avg_of_avg, CAST(sum(count) AS BIGINT) AS total "
        "FROM buckets GROUP BY server, channel",
    )

    # Parsing and reading: the same columns straight from the table.
    sql["parse_json"] = with_(
        f"rec AS ({CLICK_RECORDS})",
        "SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, "
        "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS ts, channel AS meta_channel, status AS meta_status, "
        "'[1,' || CAST(event_id % 7 AS VARCHAR) || ']' AS tags FROM rec",
    )
    sql["parse_json_fields"] = sql["flatten_json"] = sql["parse_json"]
    sql["parse_regex"] = with_(
        f"rec AS ({CLICK_RECORDS})",
        "SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type, "
        "CASE WHEN event_id % 2 = 0 THEN status END AS status FROM rec WHERE event_id % 5 <> 0",
    )
    block = (
        "SELECT event_id, CAST(event_id % 1000 AS INTEGER) AS pid, "
        "CASE event_type WHEN 'view' THEN '1200' WHEN 'purchase' THEN '1210' ELSE '1804' END AS message_id, "
        "make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts, '4000' || lpad(user_id, 12, '0') AS pan, "
        "lpad(user_id, 6, '0') AS stan, CASE event_type WHEN 'view' THEN channel ELSE '' END AS channel, "
        "CASE event_type WHEN 'purchase' THEN status ELSE '' END AS response_code FROM rec"
    )
    sql["parse_blocks"] = with_(f"rec AS ({CLICK_RECORDS})", block)
    sql["read_blocks"] = sql["parse_blocks"]
    sql["stream_blocks"] = sql["parse_blocks"]
    sql["read_blocks_whole_files"] = sql["parse_blocks"]
    sql["read_blocks_legacy"] = sql["parse_blocks"]
    sql["normalise_payment"] = with_(
        f"rec AS ({CLICK_RECORDS}),\nblk AS ({block})",
        "SELECT event_id, sha256(pan || '|' || stan) AS correlation_key, "
        "CASE message_id WHEN '1200' THEN 'REQ' ELSE 'RESP' END AS direction, ts AS event_ts, message_id, channel, "
        "response_code FROM blk WHERE message_id IN ('1200', '1210')",
    )
    sql["mask_pan_text"] = (
        "SELECT event_id, '****' || right('4000' || lpad(CAST(user_id AS VARCHAR), 12, '0'), 4) AS masked, "
        "CASE WHEN length(CAST(user_id AS VARCHAR)) <= 4 THEN '****' ELSE '****' || right(CAST(user_id AS VARCHAR), 4) END "
        "AS masked_short FROM events"
    )
    sql["hashed_key"] = (
        "SELECT event_id, sha256(CAST(user_id AS VARCHAR) || '|' || event_type) AS hashed FROM events"
    )
    sql["instant_texts"] = (
        "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN make_timestamp(epoch_us(ts) // 1000000 * 1000000) "
        "WHEN event_id % 4 = 1 THEN ts END AS instant FROM events"
    )
    sql["reject_malformed"] = (
        "SELECT CASE WHEN event_id % 10 = 0 THEN 'not a JSON object' WHEN event_id % 10 = 1 THEN 'missing core field' "
        "WHEN event_id % 10 = 2 THEN 'invalid timestamp' ELSE 'good' END AS reason, event_id "
        "FROM events WHERE event_id % 10 <> 3"
    )
    sql["transaction_time"] = (
        "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN date_trunc('second', ts) ELSE date_trunc('millisecond', ts) END "
        "AS transaction_ts FROM events"
    )
    sql["ingest_changed"] = (
        "SELECT CAST(min(event_id % 3 = 2) AS BIGINT) AS batch_id, CAST(user_id AS VARCHAR) AS correlation_key, event_type, "
        "ts AS event_ts FROM events GROUP BY ALL"
    )
    sql["read_multi_source"] = (
        "SELECT 'part-' || CAST(event_id % 4 AS VARCHAR) AS server, event_id FROM events"
    )

    # The older report set.
    sql["correlate_legacy"] = with_(CARD, f"SELECT {TX_COLUMNS}, request_id, response_id FROM done")
    sql["correlate_legacy_hot_keys"] = sql["correlate_legacy"]
    sql["transactions"] = with_(CARD, f"SELECT {TX_COLUMNS} FROM tx")
    sql["transactions_hot_keys"] = sql["transactions"]
    sql["timeout_transactions"] = with_(CARD, f"SELECT {TX_COLUMNS} FROM late")
    sql["pending_count"] = with_(CARD, "SELECT count(*) AS pending FROM waiting")
    sql["total_count"] = with_(CARD, "SELECT count(*) AS total FROM tx")
    open_keys = (
        "SELECT correlation_key FROM done WHERE is_valid AND correlation_key NOT IN "
        "(SELECT correlation_key FROM done WHERE is_valid AND CAST(stan AS BIGINT) % 3 = 0)"
    )
    sql["scan_legacy_unexported"] = with_(
        CARD, f"SELECT {TX_COLUMNS} FROM done WHERE correlation_key IN ({open_keys})"
    )
    sql["scan_legacy_unexported_limit"] = with_(
        CARD, f"SELECT {TX_COLUMNS} FROM done WHERE correlation_key IN ({open_keys} ORDER BY pair_id LIMIT 20)"
    )
    sql["legacy_export_cycle"] = with_(
        CARD,
        f"SELECT {TX_COLUMNS} FROM done WHERE correlation_key IN (SELECT correlation_key FROM done WHERE is_valid)",
    )
    sql["transaction_metrics"] = with_(
        CARD,
        "SELECT 'payment.transaction.tat' AS metric_name, 'gauge' AS metric_type, tat_millis AS value, "
        "'milliseconds' AS unit, stan AS transaction_id, channel, response_code, '****' || right(pan, 4) AS pan_masked, "
        "CAST(1704069900000 AS BIGINT) AS timestamp_ms FROM done",
    )
    sql["channel_metrics"] = with_(
        CARD,
        f"SELECT 'payment.channel.tat' AS metric_name, 'gauge' AS metric_type, channel, count(*) AS count, CAST(sum(tat_millis) AS BIGINT) AS sum_ms, {mean()} AS avg_ms, "
        "CAST(min(tat_millis) AS DOUBLE) AS min_ms, CAST(max(tat_millis) AS DOUBLE) AS max_ms, "
        "CAST(1704069900000 AS BIGINT) AS timestamp_ms FROM done GROUP BY channel",
    )
    sql["response_code_metrics"] = with_(
        CARD,
        f"SELECT 'payment.response_code.tat' AS metric_name, 'gauge' AS metric_type, response_code, count(*) AS count, {mean()} AS avg_ms, CAST(min(tat_millis) AS DOUBLE) AS min_ms, "
        f"CAST(max(tat_millis) AS DOUBLE) AS max_ms, CAST({floor_rank(95)} AS DOUBLE) AS p95_ms, "
        f"CAST({floor_rank(99)} AS DOUBLE) AS p99_ms, CAST(1704069900000 AS BIGINT) AS timestamp_ms "
        "FROM done GROUP BY response_code",
    )
    success = "count(*) FILTER (WHERE response_code = '000')"
    sql["summary_stats"] = with_(
        CARD,
        f"SELECT count(*) AS total_transactions, {mean()} AS avg_tat_ms, CAST(min(tat_millis) AS DOUBLE) AS min_tat_ms, "
        f"CAST(max(tat_millis) AS DOUBLE) AS max_tat_ms, CAST({floor_rank(50)} AS DOUBLE) AS p50_ms, "
        f"CAST({floor_rank(95)} AS DOUBLE) AS p95_ms, CAST({floor_rank(99)} AS DOUBLE) AS p99_ms, "
        f"{success} AS success_count, CAST({success} AS DOUBLE) * 100 / count(*) AS success_rate_pct, "
        "CAST(1704069900000 AS BIGINT) AS timestamp_ms FROM done",
    )
    sql["channel_series"] = with_(CARD, channel_series("done"))
    sql["series_points"] = with_(
        CARD,
        f"SELECT 'payment.transaction.tat' AS series_id, channel, response_code, {AT_MS} AS timestamp_ms, CAST(tat_millis AS DOUBLE) AS value FROM done\n"
        f"UNION ALL {channel_series('done')}",
    )
    body = lambda name: sql[name].split(CARD, 1)[1]
    sql["write_report"] = with_(
        CARD,
        " UNION ALL ".join(
            [
                melted("transaction_level_metrics", "transaction_id", ["value", "timestamp_ms"], body("transaction_metrics")),
                melted("channel_level_metrics", "channel", ["count", "sum_ms", "avg_ms", "min_ms", "max_ms"], body("channel_metrics")),
                melted("response_code_metrics", "response_code", ["count", "avg_ms", "min_ms", "max_ms", "p95_ms", "p99_ms"], body("response_code_metrics")),
                melted(
                    "summary_stats", "'summary_stats'",
                    ["total_transactions", "success_count", "avg_tat_ms", "p50_ms", "p99_ms", "success_rate_pct"], body("summary_stats"),
                ),
            ]
        ),
    )
    sql["transaction_lines"] = with_(
        CARD,
        "SELECT tat_millis AS tat_ms, stan, channel, response_code, epoch_us(completed_at) // 1000 AS timestamp, "
        "CASE WHEN tat_millis >= 0 THEN 'COMPLETED' ELSE 'TIMEOUT' END AS status FROM done WHERE is_valid",
    )
    sql["legacy_status"] = with_(
        CARD,
        "SELECT pair_id, CASE WHEN tat_millis >= 0 THEN 'COMPLETED' ELSE 'TIMEOUT' END AS status FROM tx",
    )
    sql["channel_report"] = with_(
        CARD,
        f"SELECT channel, count(*) AS cnt, {mean()} AS avg_tat, min(tat_millis) AS min_tat, max(tat_millis) AS max_tat "
        "FROM tx WHERE tat_millis > 0 GROUP BY channel ORDER BY channel",
    )
    sql["code_report"] = with_(
        CARD, "SELECT response_code, count(*) AS cnt FROM tx GROUP BY response_code ORDER BY response_code"
    )
    timed_out = "count(*) FILTER (WHERE response_code = 'TIMEOUT')"
    sql["match_report"] = with_(
        CARD, f"SELECT count(*) AS matched, {timed_out} AS timeouts FROM tx WHERE tat_millis > 0"
    )
    sql["overall_report"] = with_(
        CARD,
        f"SELECT count(*) AS total, round({mean()}, 2) AS avg_tat, min(tat_millis) AS min_tat, max(tat_millis) AS max_tat, "
        f"{success} AS success_count, {timed_out} AS timeout_count FROM tx",
    )
    sql["transaction_listing"] = with_(
        CARD,
        "SELECT pair_id, correlation_key, stan, channel, tat_millis, response_code, completed_at FROM tx "
        "ORDER BY completed_at, pair_id",
    )
    sql["correlation_health"] = with_(
        CARD,
        f"SELECT count(*) - {timed_out} AS matched, {timed_out} AS unmatched, "
        f"round((count(*) - {timed_out}) * 100.0::DOUBLE / count(*), 2) AS success_rate_pct FROM tx",
    )
    sql["latency_by_channel"] = with_(CARD, percentiles(["channel"], (50, 95, 99), "tx"))
    sql["latency_by_code"] = with_(
        CARD,
        f"SELECT response_code, count(*) AS cnt, {mean()} AS avg_tat, max(tat_millis) AS max_tat FROM tx "
        "WHERE tat_millis > 0 GROUP BY response_code",
    )
    sql["latency_trend"] = with_(
        CARD,
        f"SELECT {bucket('completed_at', 300)} AS bucket_start, channel, {mean()} AS avg_tat FROM tx GROUP BY 1, 2",
    )
    sql["slow_transactions"] = with_(
        CARD, "SELECT pair_id, stan, tat_millis, channel, response_code FROM tx WHERE tat_millis > 5000"
    )
    sql["success_by_channel"] = with_(
        CARD,
        f"SELECT channel, {success} AS success_count, count(*) AS total, "
        f"round({success} * 100.0::DOUBLE / count(*), 2) AS success_rate_pct FROM tx GROUP BY channel",
    )
    only_timeouts = "tx WHERE tat_millis = -1 AND response_code = 'TIMEOUT'"
    sql["timeouts"] = with_(CARD, f"SELECT pair_id, stan, channel, completed_at FROM {only_timeouts}")
    sql["timeouts_by_channel"] = with_(
        CARD, f"SELECT channel, count(*) AS cnt FROM {only_timeouts} GROUP BY channel"
    )
    sql["outliers_sigma"] = with_(
        CARD,
        "SELECT pair_id, stan, tat_millis, channel, response_code FROM tx "
        "WHERE tat_millis > (SELECT avg(tat_millis) + 2.0 * stddev_samp(tat_millis) FROM tx)",
    )
    sql["outliers_per_batch"] = with_(
        CARD,
        "SELECT pair_id, stan, tat_millis, channel, response_code FROM tx "
        "WHERE pair_id % 3 = 2 AND tat_millis > (SELECT avg(tat_millis) + 2.0 * stddev_samp(tat_millis) FROM tx)",
    )
    sql["p95_rank"] = with_(
        CARD, f"{percentiles(['channel', 'response_code'], (95,), 'tx')} ORDER BY p95 DESC, channel, response_code"
    )
    sql["success_trend"] = with_(
        CARD,
        f"SELECT {bucket('completed_at', 300)} AS bucket_start, channel, CAST({success} AS DOUBLE) / count(*) AS success_rate "
        "FROM tx GROUP BY 1, 2",
    )
    sql["window_stats"] = with_(
        CARD,
        f"SELECT {bucket('completed_at', 60)} AS bucket_start, channel, response_code, count(*) AS count, "
        "CAST(sum(tat_millis) AS BIGINT) AS sum_ms, CAST(trunc(CAST(sum(tat_millis) AS DOUBLE) / count(*)) AS BIGINT) AS avg_ms, "
        f"min(tat_millis) AS min_ms, max(tat_millis) AS max_ms, {floor_rank(50)} AS p50_ms, {floor_rank(95)} AS p95_ms, "
        f"{floor_rank(99)} AS p99_ms FROM tx GROUP BY 1, 2, 3",
    )
    sql["timeout_points"] = with_(
        CARD,
        f"SELECT {bucket('completed_at', 60)} AS bucket_start, channel, {timed_out} AS timeouts, "
        f"{timed_out} * 100.0::DOUBLE / count(*) AS percent FROM tx GROUP BY 1, 2 HAVING {timed_out} > 0",
    )
    return sql
