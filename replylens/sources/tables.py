"""Durable tables: one folder per batch, so that a repeated batch replaces itself.

    <root>/raw_events/batch_id=N/event_date=D   normalised events, unique by identity
    <root>/pairs/batch_id=N                     completed pairs; also the record of used events
    <root>/residual/batch_id=N                  events still unmatched after batch N
    <root>/expired/batch_id=N                   requests given up after batch N
    <root>/exports/batch_id=N                   ids of delivered pairs
    <root>/files/batch_id=N                     states of the files read
    <root>/pending/batch_id=N                   events still unmatched after matching pass N
    <root>/passes/batch_id=N                    up to which batch of raw events pass N has matched

A root belongs to one blueprint. An event id is (batch, row): the batch that stored the event and
its place in that batch's input, so ids follow the input and have no bounds.
"""

from __future__ import annotations

import functools
import itertools
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from replylens.blueprint import Blueprint
from replylens.operators import dedup
from replylens.operators.events import split_rejects, valid_events
from replylens.session import cut_lineage, temporary_stages

EVENT_ID = "struct<batch:bigint,row:bigint>"
FILES_AT_ONCE = 10_000
# Planned exports are prepared in waves of at most so many deliveries, and of about so many pairs.
DELIVERIES_AT_ONCE, PAIRS_AT_ONCE = 1_000, 1_000_000


def _cleaned(step):
    """`step(…)` deletes the intermediate tables that it wrote; it must end with a write."""

    @functools.wraps(step)
    def run(*args, **options):
        spark = next(a if isinstance(a, SparkSession) else a.sparkSession for a in args if hasattr(a, "sparkSession") or isinstance(a, SparkSession))
        with temporary_stages(spark):
            return step(*args, **options)

    return run


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _batches_at(spark: SparkSession, path: str, inside: str = "") -> list:
    """Batches of a table for which `inside` exists; the names come to Python in one piece."""
    where, fs = _folder(spark, f"{path}/batch_id=*{inside}")
    found = spark._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(fs.globStatus(where))
    names = spark._jvm.org.apache.commons.lang3.ArrayUtils.toString(found)
    return sorted(int(n) for n in re.findall(rf"/batch_id=(\d+){inside}(?=,|\}}$)", names))


def batch_ids(spark: SparkSession, path: str) -> list:
    """Batches of a table that were written completely."""
    return _batches_at(spark, path, "/_SUCCESS")


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/batch_id={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The table's rows, or those of the batches before `before`; empty if there are none.

    The folder is read as one table, partitioned by batch_id; batches that were not written completely are
    left out.
    """
    ids = [b for b in batch_ids(spark, path) if before is None or b < before]
    if not ids:
        return spark.createDataFrame([], schema + ", batch_id bigint")
    table = spark.read.schema(schema + ", batch_id bigint").parquet(path)
    if before is not None:
        table = table.filter(F.col("batch_id") < before)
    unfinished = [b for b in set(_batches_at(spark, path)) - set(ids) if before is None or b < before]
    return table.filter(~F.col("batch_id").isin(unfinished)) if unfinished else table


def drop_batches(spark: SparkSession, path: str, before: int) -> None:
    """Delete outdated versions of a table that is rewritten with every batch."""
    for batch in batch_ids(spark, path):
        if batch < before:
            where, fs = _folder(spark, f"{path}/batch_id={batch}")
            fs.delete(where, True)


def event_schema(bp: Blueprint) -> str:
    carried = "".join(f", `{c}` string" for c in bp.carried_columns)
    return (
        f"event_id {EVENT_ID}, blueprint string, event_hash string, correlation_key string, event_type string, "
        f"role string, event_ts timestamp{carried}, payload string, event_date date"
    )


def pair_schema(bp: Blueprint) -> str:
    dims = "".join(f", `{c}` string" for c in bp.dimension_columns)
    return (
        f"blueprint string, pair_id {EVENT_ID}, correlation_key string, request_id {EVENT_ID}, response_id {EVENT_ID}, "
        f"request_ts timestamp, response_ts timestamp, latency_ms bigint, outcome string{dims}"
    )


@_cleaned
def store_events(events: DataFrame, bp: Blueprint, root: str, batch_id: int) -> DataFrame:
    """Normalised events -> the ones not seen before, written as batch `batch_id` and read back.

    Identity covers the whole record if `normalise` was asked for its payload, else the carried
    columns. It holds the time, so only the stored days of this batch are compared.
    """
    spark = events.sparkSession
    path = f"{root}/raw_events"
    if "payload" not in events.columns:
        events = events.withColumn("payload", dedup.columns_payload(bp.carried_columns))
    columns = [c for c in T.StructType.fromDDL(event_schema(bp)).names if c != "event_id"]
    given = [c for c in columns if c not in ("event_hash", "event_date")]

    def identified(rows):
        return dedup.with_event_hash(rows, F.col("payload")).withColumn("event_date", F.to_date("event_ts"))

    # Rows are numbered as they are read; of copies, which are equal in every other column, the first one counts.
    numbered = valid_events(events).select(*given).withColumn("row", F.monotonically_increasing_id())
    if batch_id:
        # Written first, so that finding the days does not parse the input a second time.
        staged = cut_lineage(identified(numbered))
        days = [r[0] for r in staged.select("event_date").distinct().collect()]
        known = read_batches(spark, path, event_schema(bp), before=batch_id)
        # Only identities are shuffled to find what is new; records follow if there is anything new.
        narrow = staged.select("blueprint", "event_hash", F.xxhash64(*given).alias("copy"), "row")
        new = dedup.new_events(narrow, known.filter(F.col("event_date").isin(days)))
        first = cut_lineage(new.groupBy("blueprint", "event_hash", "copy").agg(F.min("row").alias("row")).select("row"))
        fresh = staged.join(first, "row", "left_semi")
    else:
        fresh = identified(numbered.groupBy(*given).agg(F.min("row").alias("row")))
    # Gathering days keeps a long history from becoming (tasks x days) small files; adaptive
    # execution splits a large day over several tasks again.
    by_day = fresh.hint("rebalance", "event_date")
    event_id = F.struct(F.lit(batch_id).cast("bigint").alias("batch"), "row").alias("event_id")
    write_batch(by_day.select(event_id, *columns), path, batch_id, ("event_date",))
    return read_batches(spark, path, event_schema(bp)).filter(F.col("batch_id") == batch_id).drop("batch_id")


def quarantine_records(records: DataFrame, bp: Blueprint, value: str = "value") -> tuple:
    """(good, quarantine) of flat records with `is_object`; see `split_rejects`."""
    from replylens.operators.events import event_time, event_type
    from replylens.functions import field

    missing = field(bp.key_field).isNull() | event_type(bp).isNull() | field(bp.timestamp_field).isNull()
    reason = F.when(missing, "missing core field").when(
        event_time(records, bp.timestamp_field).isNull(), "invalid timestamp"
    )
    if "is_object" in records.columns:
        reason = F.when(~F.col("is_object"), "not a JSON object").otherwise(reason)
    source = F.col("source") if "source" in records.columns else None
    return split_rejects(records, reason, F.col(value), source)


# -- pairs and exports -----------------------------------------------------------------------


def unexported(pairs: DataFrame, exports: DataFrame, limit: int | None = None) -> DataFrame:
    """Pairs without an export entry; `limit` takes the first ones by id, None takes all."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    rest = pairs.join(exports.select("pair_id"), "pair_id", "left_anti").select(*pairs.columns)
    return rest if limit is None else rest.orderBy("pair_id").limit(limit)


@_cleaned
def export_once(spark: SparkSession, bp: Blueprint, root: str, deliver, limit: int | None = None) -> int:
    """Deliver the buckets of unexported pairs, then record them. Returns the number of pairs.

    `deliver(buckets)` gets the bucket rows. If it fails nothing is recorded, so the same pairs
    are delivered by the next call (at least once).
    """
    from replylens.operators.buckets import bucket_metrics

    path = f"{root}/exports"
    pairs, done = _since_last_full(spark, root, "pairs", pair_schema(bp), "exports", f"pair_id {EVENT_ID}, exported_at timestamp")
    newest = max(batch_ids(spark, f"{root}/pairs"), default=-1)
    taken = cut_lineage(unexported(pairs, done, limit))
    number = taken.count()
    batch = max(batch_ids(spark, path), default=-1)
    if number:
        deliver(bucket_metrics(taken, bp))
        batch += 1
        write_batch(taken.select("pair_id", F.current_timestamp().alias("exported_at")), path, batch)
        if limit is None or number < limit:
            _mark_full(spark, root, "exports", newest, batch)
    return number


FULL = "upto bigint, ledger bigint"


def _since_last_full(spark: SparkSession, root: str, name: str, schema: str, ledger: str, ledger_schema: str) -> tuple:
    """(rows, ledger entries) that the last export which left nothing has not seen: other batches are not read."""
    marks = read_batches(spark, f"{root}/{ledger}_full", FULL)
    last = marks.agg(F.max("upto").alias("upto"), F.max("ledger").alias("ledger")).first()
    upto, seen = (-1 if v is None else v for v in last)
    rows = read_batches(spark, f"{root}/{name}", schema).filter(F.col("batch_id") > upto).drop("batch_id")
    return rows, read_batches(spark, f"{root}/{ledger}", ledger_schema).filter(F.col("batch_id") > seen)


def _mark_full(spark: SparkSession, root: str, ledger: str, upto: int, batch: int) -> None:
    path = f"{root}/{ledger}_full"
    write_batch(spark.createDataFrame([(upto, batch)], FULL), path, batch)
    drop_batches(spark, path, batch)


def drain(export, attempts: int = 3) -> int:
    """Call `export()`, which returns how much it delivered, until that is nothing; returns the sum.

    An export that fails is tried again, `attempts` times in a row. What fails for good stays unexported,
    and the error of the last attempt is raised.
    """
    if attempts < 1:
        raise ValueError("attempts must be positive")
    total, failed = 0, 0
    while True:
        try:
            number = export()
        except Exception:
            failed += 1
            if failed >= attempts:
                raise
            continue
        if not number:
            return total
        total, failed = total + number, 0


@_cleaned
def drain_exports(
    spark: SparkSession, bp: Blueprint, root: str, deliver, limit: int | None = None, attempts: int = 3
) -> int:
    """`export_once` until all pairs are delivered, with retries.

    With a limit, the deliveries are planned together: pairs are put in order once, and the buckets of all
    deliveries come from one aggregation. What is left over for a delivery does not grow with the table.
    """
    if limit is None:
        return drain(lambda: export_once(spark, bp, root, deliver), attempts)
    planned = PlannedExports(spark, bp, root, deliver, limit)
    try:
        return drain(planned, attempts)
    finally:
        _drop_unfinished(spark, planned.ledger)


def _drop_unfinished(spark: SparkSession, path: str) -> None:
    """Delete the batches of a table that were begun and not completed."""
    for batch in set(_batches_at(spark, path)) - set(batch_ids(spark, path)):
        where, fs = _folder(spark, f"{path}/batch_id={batch}")
        fs.delete(where, True)


class PlannedExports:
    """A call delivers the next `limit` unexported pairs in order of their ids, and returns their number.

    The ledger's rows of a wave of deliveries are written before them (`exported_at` is that time), as batches
    that are not complete yet: each delivery completes its own. So a failed delivery, or a crash, leaves all
    later ones unexported, and at most one delivery is made again.
    """

    def __init__(self, spark: SparkSession, bp: Blueprint, root: str, deliver, limit: int):
        if limit <= 0:
            raise ValueError("limit must be positive")
        self.spark, self.bp, self.root, self.deliver, self.limit = spark, bp, root, deliver, limit
        self.ledger = f"{root}/exports"
        self.per_wave = max(1, min(DELIVERIES_AT_ONCE, PAIRS_AT_ONCE // limit))
        self.total, self.next, self.written = 0, 0, -1

    def __call__(self) -> int:
        if self.next * self.limit >= self.total:
            self._plan()
        if not self.total:
            return 0
        delivery, wave = self.next, self.next // self.per_wave
        if wave > self.written:
            self._write_ledger(wave)
        rows = self.buckets.filter(f"_wave = {wave} AND _delivery = {delivery}")
        self.deliver(rows.select(*self.columns))
        where, fs = _folder(self.spark, f"{self.ledger}/batch_id={self.first + delivery}/_SUCCESS")
        fs.create(where, True).close()
        self.next += 1
        if self.next * self.limit >= self.total:
            _mark_full(self.spark, self.root, "exports", self.newest, self.first + delivery)
        return min(self.limit, self.total - delivery * self.limit)

    def _plan(self) -> None:
        from replylens.operators.buckets import bucket_metrics

        spark, root = self.spark, self.root
        schema = f"pair_id {EVENT_ID}, exported_at timestamp"
        pairs, done = _since_last_full(spark, root, "pairs", pair_schema(self.bp), "exports", schema)
        self.newest = max(batch_ids(spark, f"{root}/pairs"), default=-1)
        self.first = max(batch_ids(spark, self.ledger), default=-1) + 1
        rest = cut_lineage(unexported(pairs, done))
        # A sorted row's number holds its task and its place there: places begin where the task before ends.
        ordered = cut_lineage(rest.orderBy("pair_id").withColumn("_row", F.monotonically_increasing_id()))
        task = F.shiftright("_row", 33).alias("_task")
        sizes = sorted(tuple(r) for r in ordered.groupBy(task).count().collect())
        begins = list(itertools.accumulate((n for _, n in sizes), initial=0))
        self.total, self.next, self.written = begins.pop(), 0, -1
        if not self.total:
            return
        known = spark.createDataFrame([(t, b) for (t, _), b in zip(sizes, begins, strict=True)], "_task long, _begin long")
        place = f"_begin + (_row & {(1 << 33) - 1}L)"
        numbered = ordered.withColumn("_task", task).join(F.broadcast(known), "_task")
        numbered = numbered.withColumn("_delivery", F.expr(f"({place}) div {self.limit}L"))
        self.planned = cut_lineage(numbered.select(*rest.columns, "_delivery"))
        made = bucket_metrics(self.planned, self.bp, per=["_delivery"])
        self.columns = [c for c in made.columns if c != "_delivery"]
        wave = F.expr(f"_delivery div {self.per_wave}L").alias("_wave")
        self.buckets = cut_lineage(made.select("*", wave).hint("rebalance", "_wave"), "_wave")

    def _write_ledger(self, wave: int) -> None:
        _drop_unfinished(self.spark, self.ledger)
        begin, end = wave * self.per_wave, (wave + 1) * self.per_wave
        taken = self.planned.filter((F.col("_delivery") >= begin) & (F.col("_delivery") < end))
        batch = (F.col("_delivery") + self.first).alias("batch_id")
        rows = taken.select("pair_id", F.current_timestamp().alias("exported_at"), batch)
        rows.write.mode("append").partitionBy("batch_id").parquet(self.ledger)
        self.written = wave


# -- the older transaction table ----------------------------------------------------------------


def store_transactions(transactions: DataFrame, root: str, batch_id: int) -> None:
    """Finished transactions as batch `batch_id` of <root>/transactions; a repeated batch replaces itself."""
    from replylens.operators.legacy import TRANSACTION_COLUMNS

    write_batch(transactions.select(*TRANSACTION_COLUMNS), f"{root}/transactions", batch_id)


def read_transactions(spark: SparkSession, root: str, id_type: str = EVENT_ID) -> DataFrame:
    """The stored transactions, which the reports of `operators.reports` take."""
    schema = (
        f"pair_id {id_type}, correlation_key string, stan string, pan string, channel string, tat_millis bigint, "
        "response_code string, is_valid boolean, completed_at timestamp"
    )
    return read_batches(spark, f"{root}/transactions", schema).drop("batch_id")


@_cleaned
def export_transactions_once(
    spark: SparkSession, root: str, deliver, limit: int | None = None, id_type: str = EVENT_ID
) -> int:
    """Deliver the transactions whose key was never exported, then record their keys in
    <root>/exported_keys. Returns the number of transactions; a failed delivery records nothing."""
    from replylens.operators import legacy

    path = f"{root}/exported_keys"
    ledger = read_batches(spark, path, "correlation_key string, exported_at timestamp")
    stored = read_transactions(spark, root, id_type)
    taken = cut_lineage(legacy.unexported_transactions(stored, ledger, limit).select(*legacy.TRANSACTION_COLUMNS))
    number = taken.count()
    if number:
        deliver(taken)
        keys = legacy.exported_keys(taken).withColumn("exported_at", F.current_timestamp())
        write_batch(keys, path, max(batch_ids(spark, path), default=-1) + 1)
    return number


@_cleaned
def ingest_changed(spark: SparkSession, bp: Blueprint, root: str, paths, read, glob: str | None = None) -> int:
    """Read new, grown and rewritten files whole; events already stored are dropped by identity.

    `read(paths)` gives flat records; a MAP column `fields`, as `parse_json` adds it, is taken as the
    whole record, else all their columns are. Returns the number of files read. Files are taken
    in groups of `FILES_AT_ONCE`, a batch each; a group's states are recorded last, so a failed one is repeated.
    """
    from replylens.operators.events import normalise
    from replylens.sources.files import changed_files

    path = f"{root}/files"
    schema = "path string, length bigint, modified timestamp"
    seen = read_batches(spark, path, schema).drop("batch_id")
    changed = cut_lineage(changed_files(spark, paths, seen, glob))
    total = 0
    names = (r["path"] for r in changed.select("path").orderBy("path").toLocalIterator())
    while group := list(itertools.islice(names, FILES_AT_ONCE)):
        batch = max(batch_ids(spark, f"{root}/raw_events"), default=-1) + 1
        store_events(normalise(read(group), bp, keep=[], payload=True), bp, root, batch)
        taken = changed.filter(F.col("path").between(group[0], group[-1]))
        write_batch(taken, path, max(batch_ids(spark, path), default=-1) + 1)
        total += len(group)
    return total


@_cleaned
def correlate_pending(spark: SparkSession, bp: Blueprint, root: str, **options) -> int:
    """Match the stored events that no pair has used; write the pairs. Returns their number.

    A pass reads what the last one left and the batches stored since. Only keys with new events, or
    with a pair in the last pass, can pair now, so only those are matched. The pass is recorded last:
    a failed one is repeated and replaces what it wrote.
    """
    from replylens.operators.correlate import correlate, pending

    passes = read_batches(spark, f"{root}/passes", "raw_batch bigint")
    last = max(batch_ids(spark, f"{root}/passes"), default=-1)
    upto = next((r.raw_batch for r in passes.filter(F.col("batch_id") == last).collect()), -1)
    newest = max(batch_ids(spark, f"{root}/raw_events"), default=-1)
    fresh = read_batches(spark, f"{root}/raw_events", event_schema(bp)).filter(F.col("batch_id") > upto)
    fresh = fresh.drop("batch_id").filter((F.col("blueprint") == bp.name) & F.col("role").isNotNull())
    left = read_batches(spark, f"{root}/pending", event_schema(bp)).filter(F.col("batch_id") == last).drop("batch_id")
    paired = read_batches(spark, f"{root}/pairs", pair_schema(bp)).filter(F.col("batch_id") == last)
    keys = cut_lineage(fresh.select("correlation_key").union(paired.select("correlation_key")).distinct())
    if keys.isEmpty():
        return 0
    touched = left.join(keys, "correlation_key", "left_semi").select(*left.columns)
    waiting = fresh.unionByName(touched)
    found = dedup.dedup_pairs(correlate(waiting, bp, **options))
    write_batch(found, f"{root}/pairs", last + 1)
    found = read_batches(spark, f"{root}/pairs", pair_schema(bp)).filter(F.col("batch_id") == last + 1)
    untouched = left.join(keys, "correlation_key", "left_anti").select(*left.columns)
    write_batch(pending(waiting, found).select(*left.columns).unionByName(untouched), f"{root}/pending", last + 1)
    write_batch(spark.range(1).select(F.lit(newest).cast("bigint").alias("raw_batch")), f"{root}/passes", last + 1)
    drop_batches(spark, f"{root}/pending", last + 1)
    return found.count()


def read_once(spark: SparkSession, bp: Blueprint, root: str, paths, read, glob: str | None = None, **options) -> int:
    """One pass of the reader: take in changed files, then match what is pending."""
    ingest_changed(spark, bp, root, paths, read, glob)
    return correlate_pending(spark, bp, root, **options)


# -- sinks -----------------------------------------------------------------------------------


def write_documents(buckets: DataFrame, bp: Blueprint, path: str, mode: str = "append") -> None:
    """Export documents as text files, one document per line."""
    from replylens.operators.points import metric_documents

    metric_documents(buckets, bp).select(F.col("document").alias("value")).write.mode(mode).text(path)


def transaction_lines(transactions: DataFrame) -> DataFrame:
    """The line format of valid transactions."""
    from replylens.operators.legacy import status

    return transactions.filter("is_valid").select(
        F.col("tat_millis").alias("tat_ms"),
        "stan",
        "channel",
        "response_code",
        F.unix_millis("completed_at").alias("timestamp"),
        status(F.col("tat_millis")).alias("status"),
    )


def write_transaction_lines(transactions: DataFrame, path: str, mode: str = "append") -> None:
    transaction_lines(transactions).write.mode(mode).json(path)


def write_report(transactions: DataFrame, path: str, at_ms, mode: str = "overwrite") -> None:
    """The four-section report, one folder of JSON lines per section: the transaction section
    has a row per transaction, so the report is not gathered into one document."""
    from replylens.operators import reports

    sections = {
        "transaction_level_metrics": reports.transaction_metrics,
        "channel_level_metrics": reports.channel_metrics,
        "response_code_metrics": reports.response_code_metrics,
        "summary_stats": reports.summary_stats,
    }
    for name, build in sections.items():
        build(transactions, at_ms).write.mode(mode).json(f"{path}/{name}")
