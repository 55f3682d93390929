import os
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from replylens import Blueprint
from replylens.operators import dedup as D
from replylens.operators import legacy as L
from replylens.operators import parse as P
from replylens.operators.buckets import bucket_metrics
from replylens.operators.correlate import correlate
from replylens.operators.events import matchable
from replylens.sources import files, tables
from replylens.streaming import tail as S

BP = Blueprint(
    name="generic-json",
    key_field="request_id",
    request_type_field="kind",
    response_type_field="kind",
    request_value="begin",
    response_value="finish",
    timestamp_field="occurred_at",
    dimensions=("operation",),
    status_field="status",
    success_values={"ok"},
)


def line(key, kind, at, **more):
    pairs = {"request_id": key, "kind": kind, "occurred_at": f"2026-10-01T10:00:{at}Z", **more}
    return "{" + ",".join(f'"{k}":"{v}"' for k, v in pairs.items()) + "}\n"


FIRST = "{invalid json}\n" + line("txn-7", "begin", "00", operation="lookup")
FIRST += line("txn-7", "finish", "00.125", operation="lookup", status="ok")


def reader(spark):
    def read(paths):
        return P.parse_json_fields(P.not_blank(files.read_lines(spark, paths)), BP.source_fields).filter("is_object")

    return read


def stored_pairs(spark, root):
    return tables.read_batches(spark, f"{root}/pairs", tables.pair_schema(BP)).drop("batch_id")


def stored_events(spark, root):
    return tables.read_batches(spark, f"{root}/raw_events", tables.event_schema(BP))


def touch(path, text):
    path.write_text(text)
    stamp = time.time() + touch.step
    touch.step += 5
    os.utime(path, (stamp, stamp))


touch.step = 5


def test_replay_gives_no_second_pair(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, FIRST)
    for _ in range(2):
        tables.read_once(spark, BP, root, [str(source)], reader(spark))
    (pair,) = stored_pairs(spark, root).collect()
    assert (pair["latency_ms"], pair["outcome"], pair["operation"]) == (125, "SUCCESS", "lookup")
    assert stored_events(spark, root).count() == 2


def test_rewritten_and_grown_files_are_read_again(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, FIRST)
    tables.read_once(spark, BP, root, [str(source)], reader(spark))
    touch(source, FIRST.replace("txn-7", "txn-8"))  # same length
    tables.read_once(spark, BP, root, [str(source)], reader(spark))
    assert stored_pairs(spark, root).count() == 2
    touch(source, FIRST.replace("txn-7", "txn-8") + line("txn-9", "begin", "01") + line("txn-9", "finish", "01.250"))
    assert tables.ingest_changed(spark, BP, root, [str(source)], reader(spark)) == 1
    tables.correlate_pending(spark, BP, root)
    assert sorted(r["latency_ms"] for r in stored_pairs(spark, root).collect()) == [125, 125, 250]
    assert stored_events(spark, root).count() == 6
    assert tables.ingest_changed(spark, BP, root, [str(source)], reader(spark)) == 0


def test_unmatched_event_survives_a_restart(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, line("a", "begin", "00"))
    assert tables.read_once(spark, BP, root, [str(source)], reader(spark)) == 0
    touch(source, line("a", "begin", "00") + line("a", "finish", "02"))
    assert tables.read_once(spark, BP, root, [str(source)], reader(spark)) == 1


def test_ids_are_unique_over_batches(spark, tmp_path):
    root = str(tmp_path / "t")
    records = spark.createDataFrame([(f"k{i}", "begin", f"2026-10-0{1 + i % 9}T10:00:00Z", None, None) for i in range(200)], "request_id string, kind string, occurred_at string, operation string, status string")
    from replylens.operators.events import normalise

    for batch in range(3):
        part = normalise(records.filter(F.substring("request_id", 2, 9).cast("int") % 3 <= batch), BP)
        tables.store_events(part, BP, root, batch)
    got = stored_events(spark, root)
    assert got.count() == 200 and got.select("event_id").distinct().count() == 200
    # A repeated batch replaces itself.
    tables.store_events(normalise(records, BP), BP, root, 2)
    assert stored_events(spark, root).count() == 200


def test_only_identities_are_compared_with_the_stored_events(spark, tmp_path, monkeypatch):
    """Copies, known and new records in one batch; one identity whose stored columns differ counts twice."""
    from replylens.operators.events import normalise

    root, compared, plain = str(tmp_path / "t"), [], tables.dedup.new_events
    monkeypatch.setattr(tables.dedup, "new_events", lambda events, stored: compared.append(set(events.columns)) or plain(events, stored))
    schema = "request_id string, kind string, occurred_at string, operation string, status string"

    def events(*keys):
        rows = [(k, "begin", f"2026-10-0{1 + i % 2}T10:00:00Z", None, None) for i, k in enumerate(keys)]
        return normalise(spark.createDataFrame(rows, schema).coalesce(1), BP)

    tables.store_events(events("a", "b", "a"), BP, root, 0)
    assert tables.store_events(events("a", "b", "a"), BP, root, 1).count() == 0
    new = events("a", "b", "a", "x", "c", "y", "c").unionByName(events("c")).withColumn("payload", F.lit("same"))
    new = new.withColumn("operation", F.when(F.col("correlation_key") == "y", "z")).unionByName(new.filter("correlation_key = 'y'"))
    got = tables.store_events(new.filter("correlation_key in ('c', 'x', 'y')"), BP, root, 2)
    assert sorted((r.correlation_key, str(r.operation), str(r.event_date)[-2:]) for r in got.collect()) == [
        ("c", "None", "01"), ("x", "None", "02"), ("y", "None", "02"), ("y", "z", "02"),
    ]
    assert len(compared) == 2 and not any({"payload", "operation", "status"} & c for c in compared)


def test_failed_export_is_retried(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, line("txn-9", "begin", "00") + line("txn-9", "finish", "00.250"))
    tables.read_once(spark, BP, root, [str(source)], reader(spark))

    def broken(buckets):
        raise IOError("503")

    with pytest.raises(IOError):
        tables.export_once(spark, BP, root, broken)
    delivered = []
    assert tables.export_once(spark, BP, root, lambda b: delivered.extend(b.collect())) == 1
    assert delivered[0]["max_latency_ms"] == 250
    assert tables.export_once(spark, BP, root, broken) == 0


def test_export_limit_splits_a_bucket(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, "".join(line(f"k{i}", "begin", f"{i:02d}") + line(f"k{i}", "finish", f"{i:02d}.100") for i in range(5)))
    tables.read_once(spark, BP, root, [str(source)], reader(spark))
    counts = []
    while tables.export_once(spark, BP, root, lambda b: counts.extend(r["count"] for r in b.collect()), limit=2):
        pass
    assert counts == [2, 2, 1]
    with pytest.raises(ValueError):
        tables.export_once(spark, BP, root, print, limit=0)


def test_identity_ignores_field_order(spark):
    df = spark.sql(
        """SELECT 'b' blueprint, 'k' correlation_key, 't' event_type, timestamp'2026-10-01' event_ts, 1L event_id, map('a','1','b','2') f
        UNION ALL SELECT 'b','k','t',timestamp'2026-10-01',2L,map('b','2','a','1')
        UNION ALL SELECT 'b','k','t',timestamp'2026-10-01',3L,map('a','1','b','3')
        UNION ALL SELECT 'c','k','t',timestamp'2026-10-01',4L,map('a','1','b','2')"""
    )
    hashed = D.with_event_hash(df, D.payload(F.col("f"))).drop("f")
    assert sorted(r["event_id"] for r in D.dedup_events(hashed).collect()) == [1, 3, 4]


def test_payload_of_columns_sorts_no_row(spark):
    """The text of the sorted map, written from a plain struct."""
    df = spark.sql(
        """SELECT 'a"\u00e9\n/' b, string(null) `a.x`, 1.50D Z, timestamp'2026-10-01 00:00:01.5' `\u00e9`, true A_
        UNION ALL SELECT null, '<q>', null, null, null UNION ALL SELECT null, null, null, null, null"""
    )
    both = df.select(D.payload(D.columns_as_fields(df.columns)).alias("map"), D.columns_payload(df.columns).alias("columns"))
    assert all(r["map"] == r["columns"] for r in both.collect()) and both.filter("columns = '{}'").count() == 1
    records = spark.createDataFrame([("k", "begin", "2026-10-01T10:00:00Z", "1")], "request_id string, kind string, occurred_at string, amount string")
    from replylens.operators.events import normalise

    planned = normalise(records.withColumns({c: F.lit(None).cast("string") for c in ("operation", "status")}), BP, payload=True)
    assert planned.first()["payload"] == '{"amount":"1","kind":"begin","occurred_at":"2026-10-01T10:00:00Z","request_id":"k"}'
    assert "sort" not in planned._jdf.queryExecution().optimizedPlan().toString()


def test_quarantine(spark):
    lines = spark.createDataFrame([(x,) for x in FIRST.splitlines() + [line("a", "begin", "99"), '{"kind":"begin"}']], "value string")
    good, bad = tables.quarantine_records(P.parse_json_fields(lines, BP.source_fields), BP)
    assert good.count() == 2
    assert sorted(r["reason"] for r in bad.collect()) == ["invalid timestamp", "missing core field", "not a JSON object"]


def test_reports_are_written(spark, tmp_path):
    tx = spark.sql(
        """SELECT 1L pair_id, 'p|s' correlation_key, '11' stan, '4111111111111111' pan, 'UPI' channel, 100L tat_millis,
        '000' response_code, true is_valid, timestamp'2026-10-01' completed_at
        UNION ALL SELECT 2L,'p|s','11','4','UPI',70000L,'001',false,timestamp'2026-10-01'"""
    )
    tables.write_report(tx, str(tmp_path / "report"), F.lit(5).cast("bigint"))
    assert spark.read.json(str(tmp_path / "report/transaction_level_metrics")).count() == 2
    summary = spark.read.json(str(tmp_path / "report/summary_stats")).first()
    assert (summary["success_rate_pct"], summary["p95_ms"]) == (50.0, 70000.0)
    tables.write_transaction_lines(tx, str(tmp_path / "lines"))
    (row,) = spark.read.json(str(tmp_path / "lines")).collect()
    assert (row["tat_ms"], row["status"], row["stan"]) == (100, "COMPLETED", "11")
    # The invalid row shares the key of a valid one, so it comes along; an exported key never does.
    nothing = tx.limit(0)
    assert L.unexported_transactions(tx, nothing).count() == 2
    assert L.unexported_transactions(tx, nothing, limit=1, hot_rows=0).count() == 2
    assert L.unexported_transactions(tx, L.exported_keys(tx)).count() == 0


# -- streams --------------------------------------------------------------------------------


def deliver(folder, name, text):
    folder.mkdir(exist_ok=True)
    touch(folder / name, text)


def parse(lines):
    return P.parse_json_fields(P.not_blank(lines), BP.source_fields).filter("is_object")


def run(spark, folder, root, **options):
    lines = files.stream_lines(spark, str(folder), max_files=1)
    S.tail(lines, BP, root, parse, mode="batch", **options).awaitTermination()


def test_stream_equals_batch_for_ordered_deliveries(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    text = [line(f"k{i % 7}", "begin" if (i // 7) % 2 == 0 else "finish", f"{i:02d}") for i in range(56)]
    for part in range(4):
        deliver(folder, f"{part}.jsonl", "".join(text[part * 14 : part * 14 + 14]))
    run(spark, folder, root)
    names = ["correlation_key", "request_ts", "response_ts"]
    got = {tuple(r) for r in stored_pairs(spark, root).select(*names).collect()}
    batch = matchable(parse(files.read_lines(spark, str(folder))).withColumn("event_id", F.monotonically_increasing_id()), BP)
    assert got == {tuple(r) for r in correlate(batch, BP).select(*names).collect()} and len(got) == 28


def test_stream_resumes_and_matches_late_events(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    deliver(folder, "1.jsonl", line("a", "finish", "05") + line("b", "begin", "10"))
    run(spark, folder, root)
    assert stored_pairs(spark, root).count() == 0
    # The request arrives after its response; an event that was already stored is ignored.
    deliver(folder, "2.jsonl", line("a", "begin", "01") + line("b", "begin", "10") + line("b", "finish", "11"))
    run(spark, folder, root)
    assert sorted(r["latency_ms"] for r in stored_pairs(spark, root).collect()) == [1000, 4000]
    assert stored_events(spark, root).count() == 4
    residual = tables.batch_ids(spark, f"{root}/residual")
    assert residual == [0, 1]


def test_stream_carries_shadowed_requests(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    deliver(folder, "1.jsonl", line("k", "begin", "01") + line("k", "begin", "02") + line("k", "finish", "03") + line("k", "finish", "04"))
    deliver(folder, "2.jsonl", line("z", "begin", "05"))
    run(spark, folder, root)
    assert sorted(r["latency_ms"] for r in stored_pairs(spark, root).collect()) == [2000, 2000]


def test_stream_gives_up_requests_behind_the_newest_event(spark, tmp_path):
    bp_wait = Blueprint(**{**BP.__dict__, "timeout": timedelta(seconds=5)})
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    deliver(folder, "1.jsonl", line("a", "begin", "00") + line("b", "finish", "00") + line("c", "begin", "09"))
    deliver(folder, "2.jsonl", line("d", "begin", "20"))
    lines = files.stream_lines(spark, str(folder), max_files=1)
    S.tail(lines, bp_wait, root, parse, mode="batch", lateness=timedelta(seconds=2)).awaitTermination()
    expired = tables.read_batches(spark, f"{root}/expired", tables.event_schema(BP))
    assert {(r["correlation_key"], r["batch_id"]) for r in expired.collect()} == {("a", 0), ("c", 1)}
    left = tables.read_batches(spark, f"{root}/residual", tables.event_schema(BP)).filter("batch_id = 1")
    assert [r["correlation_key"] for r in left.collect()] == ["d"]


def test_tumbling_equals_batch(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    for part in range(3):
        rows = [line(f"k{part}-{i}", "begin", f"{i:02d}", operation="x") + line(f"k{part}-{i}", "finish", f"{i:02d}.{i * 7:03d}", operation="x", status="ok") for i in range(20)]
        deliver(folder, f"{part}.jsonl", "".join(rows).replace("T10:00", f"T10:0{part}"))
    run(spark, folder, root)
    every = {tuple(r) for r in bucket_metrics(stored_pairs(spark, root), BP).collect()}
    assert S.tumbling_metrics(spark, BP, root) == 3
    closed = S.stored_buckets(spark, BP, root).drop("late")
    # The last minute stays open until a later pair arrives, or the run ends.
    assert {tuple(r) for r in closed.collect()} == {r for r in every if r[0].minute < 2}
    assert S.tumbling_metrics(spark, BP, root, mode="batch") == 0
    assert {tuple(r) for r in S.stored_buckets(spark, BP, root).drop("late").collect()} == every
    deliver(folder, "late.jsonl", line("late", "begin", "30") + line("late", "finish", "31"))
    run(spark, folder, root)
    assert S.tumbling_metrics(spark, BP, root) == 1
    (late,) = S.stored_buckets(spark, BP, root).filter("late").collect()
    assert (late["count"], late["max_latency_ms"], late["bucket_start"].minute) == (1, 1000, 0)


def test_unfinished_batches_are_not_followed(spark, tmp_path):
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    deliver(folder, "1.jsonl", line("a", "begin", "00") + line("a", "finish", "01"))
    run(spark, folder, root)
    stored_pairs(spark, root).write.parquet(f"{root}/pairs/batch_id=1")
    os.remove(f"{root}/pairs/batch_id=1/_SUCCESS")
    assert S.tumbling_metrics(spark, BP, root, mode="batch") == 1
    assert [r["count"] for r in S.stored_buckets(spark, BP, root).collect()] == [1]


def test_events_that_differ_in_an_unnamed_field(spark, tmp_path):
    """Four records of one key, read twice, as file and as stream: four events and two pairs."""
    text = "".join(
        line("k", kind, at, amount=amount)
        for kind, at, amount in [("begin", "00", 1), ("begin", "00", 2), ("finish", "01", 1), ("finish", "01", 2)]
    )
    whole = lambda lines: P.fields_as_columns(P.parse_json(P.not_blank(lines)).withColumn("f", F.col("fields")), BP.source_fields).withColumnRenamed("f", "fields")
    root, folder = str(tmp_path / "t"), tmp_path / "in"
    for name in ("1.jsonl", "2.jsonl"):
        deliver(folder, name, text)
    tables.read_once(spark, BP, root, [str(folder)], lambda paths: whole(files.read_lines(spark, paths)))
    tables.correlate_pending(spark, BP, root)
    assert stored_events(spark, root).count() == 4 and stored_pairs(spark, root).count() == 2
    assert {r[0] for r in stored_events(spark, root).select(F.get_json_object("payload", "$.amount")).collect()} == {"1", "2"}
    root = str(tmp_path / "stream")
    lines = files.stream_lines(spark, str(folder), max_files=1)
    S.tail(lines, BP, root, whole, mode="batch").awaitTermination()
    assert stored_events(spark, root).count() == 4 and stored_pairs(spark, root).count() == 2


def test_ids_have_no_bounds_and_follow_the_input(spark, tmp_path):
    from replylens.operators.events import normalise

    root = str(tmp_path / "t")
    rows = [(f"k{i}", "begin", "2026-10-01T10:00:00Z", None, None) for i in range(500)]
    records = spark.createDataFrame(rows, "request_id string, kind string, occurred_at string, operation string, status string")
    for batch in (1 << 21, 1 << 40):
        part = normalise(records.withColumn("request_id", F.concat("request_id", F.lit(f"-{batch}"))), BP)
        tables.store_events(part, BP, root, batch)
    got = [r["correlation_key"] for r in stored_events(spark, root).orderBy("event_id").collect()]
    assert got == [f"k{i}-{b}" for b in (1 << 21, 1 << 40) for i in range(500)]


def test_pass_reads_and_writes_changed_keys_only(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, "".join(line(f"k{i}", "begin", "00") for i in range(20)))
    assert tables.read_once(spark, BP, root, [str(source)], reader(spark)) == 0
    touch(source, line("k3", "finish", "01") + line("new", "begin", "02"))
    assert tables.read_once(spark, BP, root, [str(source)], reader(spark)) == 1
    pending = tables.read_batches(spark, f"{root}/pending", tables.event_schema(BP))
    assert tables.batch_ids(spark, f"{root}/pending") == [1] and pending.count() == 20
    assert tables.correlate_pending(spark, BP, root) == 0
    # Nothing is new, and no key had a pair in the pass before: nothing is written.
    assert tables.correlate_pending(spark, BP, root) == 0
    passes = tables.batch_ids(spark, f"{root}/passes")
    assert tables.correlate_pending(spark, BP, root) == 0 and tables.batch_ids(spark, f"{root}/passes") == passes


def test_drain_retries_and_gives_up(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, "".join(line(f"k{i}", "begin", f"{i:02d}") + line(f"k{i}", "finish", f"{i:02d}.100") for i in range(5)))
    tables.read_once(spark, BP, root, [str(source)], reader(spark))
    calls = []

    def deliver(buckets):
        calls.append(1)
        if len(calls) < 3:
            raise IOError("503")

    with pytest.raises(IOError):
        tables.drain_exports(spark, BP, root, deliver, limit=2, attempts=2)
    assert tables.drain_exports(spark, BP, root, deliver, limit=2, attempts=2) == 5


def test_drain_does_the_shared_work_once(spark, tmp_path, monkeypatch):
    """Nine deliveries in waves of four, one of which fails once: jobs come with a wave, not with a delivery."""
    root = str(tmp_path / "t")
    ids = "named_struct('batch', 0L, 'row', id)"
    pairs = spark.range(0, 52, 3).selectExpr(
        f"'{BP.name}' blueprint", f"{ids} pair_id", "string(id) correlation_key", f"{ids} request_id", f"{ids} response_id",
        "timestamp_seconds(id) request_ts", "timestamp_seconds(id + 1) response_ts", "1000 + id latency_ms", "'SUCCESS' outcome",
        "if(id % 2 = 0, 'x', null) operation",
    )
    tables.write_batch(pairs.repartition(5), f"{root}/pairs", 0)
    rows = sorted(pairs.collect(), key=lambda r: r.pair_id)
    monkeypatch.setattr(tables, "DELIVERIES_AT_ONCE", 4)
    delivered, planned, plan = [], [], tables.PlannedExports._plan
    monkeypatch.setattr(tables.PlannedExports, "_plan", lambda self: planned.append(1) or plan(self))

    def deliver(buckets):
        if len(delivered) == 5 and not planned[1:]:
            planned.append(0)
            raise IOError("503")
        delivered.append({tuple(r) for r in buckets.collect()})

    assert tables.drain_exports(spark, BP, root, deliver, limit=2) == 18
    parts = [rows[i : i + 2] for i in range(0, 18, 2)]
    assert delivered == [{tuple(r) for r in bucket_metrics(spark.createDataFrame(p, pairs.schema), BP).collect()} for p in parts]
    # Once for all, once to find that nothing is left.
    assert planned == [1, 0, 1]
    ledger = tables.read_batches(spark, f"{root}/exports", f"pair_id {tables.EVENT_ID}, exported_at timestamp")
    assert sorted((r.batch_id, r.pair_id) for r in ledger.collect()) == [(i // 2, r.pair_id) for i, r in enumerate(rows)]


def test_a_drain_that_stops_records_what_was_delivered(spark, tmp_path):
    root, source = str(tmp_path / "t"), tmp_path / "events.jsonl"
    touch(source, "".join(line(f"k{i}", "begin", f"{i:02d}") + line(f"k{i}", "finish", f"{i:02d}.100") for i in range(7)))
    tables.read_once(spark, BP, root, [str(source)], reader(spark))
    counts = []

    def deliver(buckets):
        if len(counts) == 2:
            raise IOError("503")
        counts.extend(r["count"] for r in buckets.collect())

    with pytest.raises(IOError):
        tables.drain_exports(spark, BP, root, deliver, limit=2)
    assert tables.batch_ids(spark, f"{root}/exports") == tables._batches_at(spark, f"{root}/exports") == [0, 1]
    # What a crash leaves behind is not taken for exported.
    stored_pairs(spark, root).select("pair_id", F.current_timestamp().alias("exported_at")).write.parquet(f"{root}/exports/batch_id=2")
    os.remove(f"{root}/exports/batch_id=2/_SUCCESS")
    assert tables.drain_exports(spark, BP, root, lambda b: counts.extend(r["count"] for r in b.collect()), limit=2) == 3
    assert counts == [2, 2, 2, 1] and tables.batch_ids(spark, f"{root}/exports") == [0, 1, 2, 3]
    with pytest.raises(ValueError, match="limit"):
        tables.drain_exports(spark, BP, root, print, limit=0)


def test_modes(spark, tmp_path):
    lines = spark.readStream.format("rate").load()
    for bad in ({"mode": "poll"}, {"poll_ms": 0}):
        with pytest.raises(ValueError):
            S.tail(lines, BP, str(tmp_path), **bad)
