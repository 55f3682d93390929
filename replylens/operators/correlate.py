"""One-to-one matching of requests with responses under an event-time timeout.

Per key, in the order (time, requests first, event id): a request waits if none is waiting,
a waiting request older than the timeout is dropped when the next event arrives, and a
response takes the waiting request. So every response, and every silence longer than the
timeout, ends an *island* of events that is independent of the rest. In an island the request
that waits first is the island's first event. It is the match unless the island has gone on
for longer than the timeout with nothing but requests (a *storm*). Only then the chain of
replacements (first request more than a timeout after the waiting one) has to be followed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replylens.blueprint import Blueprint, column_of
from replylens.functions import latency_ms, outcome, prefer_response
from replylens.operators import skew
from replylens.operators.events import REQUEST, RESPONSE
from replylens.session import cut_lineage

KEY = "correlation_key"
HOT_ROWS = 1_000_000
BROADCAST_ROWS = 100_000


def _steps(events: DataFrame, position: Column, fields: list) -> DataFrame:
    """(key, us, ord, id, body): the narrow rows that the match needs."""
    return events.filter(F.col("role").isin(REQUEST, RESPONSE)).select(
        F.col(KEY),
        position.alias("us"),
        F.when(F.col("role") == REQUEST, 0).otherwise(1).alias("ord"),
        F.col("event_id").alias("id"),
        F.struct(F.col("event_ts").alias("ts"), *[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)]).alias(
            "body"
        ),
    )


def _match_by_key(steps: DataFrame, timeout_us: int | None) -> DataFrame:
    """Keys that fit one task: a single exchange on the key, shared by window and grouping.

    Without a timeout, the request still waiting at the end of a key is returned with p NULL.
    """
    w = Window.partitionBy(KEY).orderBy("us", "ord", "id")
    opens = F.lag("us").over(w).isNull() | (F.lag("ord").over(w) == 1)
    if timeout_us is not None:
        opens = opens | (F.col("us") - F.lag("us").over(w) > timeout_us)
    one = F.struct("us", "id", "body")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        steps.withColumns({"opens": opens, "ends": F.lead("us").over(w).isNull(), "one": one})
        .withColumn("island", F.sum(F.col("opens").cast("bigint")).over(so_far))
        .withColumn(
            "first", F.last(F.when(F.col("opens"), F.struct("ord", "one")), ignorenulls=True).over(so_far)
        )
        .filter(F.col("first.ord") == 0)
    )
    answered = F.col("ord") == 1
    if timeout_us is None:
        return rows.filter(answered | F.col("ends")).select(
            KEY, F.col("first.one").alias("q"), F.when(answered, F.col("one")).alias("p")
        )
    # Requests that cannot replace the island's first one are dropped before the grouping.
    late = F.col("us") - F.col("first.one.us") > timeout_us
    grouped = (
        rows.filter(answered | late)
        .groupBy(KEY, "island")
        .agg(
            F.first("first.one").alias("first"),
            F.max(F.when(answered, F.col("one"))).alias("p"),
            F.collect_list(F.when(~answered, F.col("one"))).alias("late"),
        )
        .filter(F.col("p").isNotNull())
    )
    waiting = F.aggregate(
        F.sort_array("late"),
        F.col("first"),
        lambda live, r: F.when(r["us"] - live["us"] > timeout_us, r).otherwise(live),
    )
    return (
        grouped.select(KEY, F.when(F.size("late") == 0, F.col("first")).otherwise(waiting).alias("q"), "p")
        .filter(F.col("p.us") - F.col("q.us") <= timeout_us)
    )


def _match_by_segment(steps: DataFrame, timeout_us: int | None, rows: int, per_segment: int) -> DataFrame:
    """Keys too large for one task: the same match, spread over range-partitioned segments."""
    one = F.struct("us", "id", "body")
    # Of all events of a key at one instant only the first request and the first response
    # can matter, since requests come first. This also collapses copies map-side.
    ticks = steps.groupBy(KEY, "us").agg(
        F.min(F.when(F.col("ord") == 0, one)).alias("q"),
        F.min(F.when(F.col("ord") == 1, one)).alias("p"),
    )
    ticks = skew.into_segments(ticks, [KEY], ["us"], skew.segment_count(rows, per_segment))
    before = F.struct(F.col("us"), F.col("p").isNotNull().alias("answered"))
    # `carry` uses its input twice; the second one starts from what the first one wrote.
    ticks = cut_lineage(skew.carry(ticks, [KEY], ["us"], before, "before", inclusive=False))
    opens = F.col("before").isNull() | F.col("before.answered")
    if timeout_us is not None:
        opens = opens | (F.col("us") - F.col("before.us") > timeout_us)
    ticks = skew.carry(ticks, [KEY], ["us"], F.when(opens, F.struct("us", "q")), "first")
    ticks = ticks.filter(F.col("first.q").isNotNull())
    if timeout_us is None:
        ticks = skew.carry(ticks, [KEY], ["us"], F.lit(True), "more", backward=True, inclusive=False)
        shown = F.col("p").isNotNull() | F.col("more").isNull()
        return ticks.filter(shown).select(KEY, F.col("first.q").alias("q"), "p")
    ticks = cut_lineage(
        ticks.select(KEY, "us", "q", "p", F.col("first.us").alias("island"), F.col("first.q").alias("first"))
    )
    answered = ticks.filter(F.col("p").isNotNull())
    direct = answered.filter(F.col("us") - F.col("island") <= timeout_us)
    direct = direct.select(KEY, F.col("first").alias("q"), "p")
    storms = answered.filter(F.col("us") - F.col("island") > timeout_us).select(KEY, "island", "p")
    # One storm lasts longer than the timeout, so there are few; the number is checked anyway.
    found = storms.count()
    if not found:
        return direct
    small = F.broadcast(storms.select(KEY, "island")) if found <= BROADCAST_ROWS else storms.select(KEY, "island")
    asked = ticks.filter(F.col("q").isNotNull()).join(small, [KEY, "island"], "left_semi").select(
        KEY, "island", "us", "q"
    )
    last = _last_in_chain(asked.select(KEY, "island", "us"), timeout_us, per_segment)
    chained = (
        storms.join(last, [KEY, "island"])
        .filter(F.col("p.us") - F.col("last_us") <= timeout_us)
        .join(asked.select(KEY, "island", F.col("us").alias("last_us"), "q"), [KEY, "island", "last_us"])
        .select(KEY, "q", "p")
    )
    return direct.unionByName(chained)


def _last_in_chain(asked: DataFrame, timeout_us: int, per_segment: int) -> DataFrame:
    """(key, island, last_us): the end of the replacement chain from each island's first request.

    Every request points to the first request more than a timeout later; pointers are then
    doubled, so a chain of n replacements takes about log2(n) joins.
    """
    ids = [KEY, "island"]
    targets = asked.withColumn("at", F.col("us")).withColumn("probe", F.lit(0))
    probes = asked.withColumn("at", F.col("us") + timeout_us).withColumn("probe", F.lit(1))
    both = targets.unionByName(probes)
    both = skew.into_segments(
        both, ids, ["at", "probe"], skew.segment_count(2 * asked.count(), per_segment)
    )
    target = F.when(F.col("probe") == 0, F.col("us"))
    both = skew.carry(both, ids, ["at", "probe"], target, "next", backward=True, inclusive=False)
    # `done` pointers end at the last request of their island.
    hops = both.filter(F.col("probe") == 1).select(
        *ids, "us", F.coalesce("next", "us").alias("next"), F.col("next").isNull().alias("done")
    )
    while True:
        hops = cut_lineage(hops)
        starts = hops.filter(F.col("us") == F.col("island"))
        if starts.filter(~F.col("done")).isEmpty():
            return starts.select(*ids, F.col("next").alias("last_us"))
        onward = hops.select(
            *ids, F.col("us").alias("next"), F.col("next").alias("hop"), F.col("done").alias("hop_done")
        )
        moved = (
            hops.filter(~F.col("done"))
            .join(onward, [*ids, "next"])
            .select(*ids, "us", F.col("hop").alias("next"), F.col("hop_done").alias("done"))
        )
        hops = moved.unionByName(hops.filter(F.col("done")))


def _match(events, position, fields, timeout_us, hot_rows, per_segment, parsed_once=None) -> DataFrame:
    steps = _steps(events, position, fields)
    if hot_rows is None:
        return _match_by_key(steps, timeout_us)
    if not skew.is_columnar_scan(steps) if parsed_once is None else parsed_once:
        # Counted and matched from the narrow rows, so that a source is read and parsed once.
        steps = cut_lineage(steps)
    hot = skew.find_hot_keys(steps, KEY, hot_rows)
    if not hot.keys:
        return _match_by_key(steps, timeout_us)
    heavy, rest = skew.split_by_keys(steps, KEY, hot)
    return _match_by_key(rest, timeout_us).unionByName(_match_by_segment(heavy, timeout_us, hot.rows, per_segment))


def correlate(
    events: DataFrame,
    bp: Blueprint,
    empty_as_null: bool = False,
    hot_rows: int | None = HOT_ROWS,
    per_segment: int = skew.ROWS_PER_SEGMENT,
    parsed_once: bool | None = None,
) -> DataFrame:
    """Events (event_id, correlation_key, role, event_ts, carried fields) -> pairs.

    Keys with more than `hot_rows` events are matched in segments; `None` skips the count of
    events per key, which is the only guard against a key that is too large for one task. Filters and
    projections of Parquet or ORC files are scanned for the keys alone; for any other source, or with `parsed_once`,
    the narrow rows are written first, and counted and matched from there, so it is evaluated once. The result is the same either way. A response belongs to at most one pair,
    so its id serves as the pair's id.
    """
    matched = _match(events, F.unix_micros("event_ts"), bp.carried_columns, bp.timeout_us, hot_rows, per_segment, parsed_once)
    return pair_rows(matched, bp, empty_as_null)


def pair_rows(matched: DataFrame, bp: Blueprint, empty_as_null: bool = False) -> DataFrame:
    """(key, q, p), each side with id and body (ts and the carried columns as f0, f1, ...) -> pairs."""
    fields = bp.carried_columns

    def side(name, c):
        return F.col(f"{name}.body.f{fields.index(c)}")

    status = side("p", column_of(bp.status_field)) if bp.status_field else None
    return matched.select(
        F.lit(bp.name).alias("blueprint"),
        F.col("p.id").alias("pair_id"),
        F.col(KEY),
        F.col("q.id").alias("request_id"),
        F.col("p.id").alias("response_id"),
        F.col("q.body.ts").alias("request_ts"),
        F.col("p.body.ts").alias("response_ts"),
        latency_ms(F.col("q.body.ts"), F.col("p.body.ts")).alias("latency_ms"),
        outcome(status, bp.success_values).alias("outcome"),
        *[prefer_response(side("p", d), side("q", d), empty_as_null).alias(d) for d in bp.dimension_columns],
    )


def matched_ids(pairs: DataFrame) -> DataFrame:
    """The event ids used by the pairs, one row each."""
    return pairs.select(F.explode(F.array("request_id", "response_id")).alias("event_id"))


def pending(events: DataFrame, pairs: DataFrame) -> DataFrame:
    """Events that no pair has used."""
    return events.join(matched_ids(pairs), "event_id", "left_anti")


def unmatched_requests(events: DataFrame, pairs: DataFrame) -> DataFrame:
    return pending(events.filter(F.col("role") == REQUEST), pairs)


def orphan_responses(events: DataFrame, pairs: DataFrame) -> DataFrame:
    return pending(events.filter(F.col("role") == RESPONSE), pairs)


def correlate_passes(events: DataFrame, bp: Blueprint, passes: int | None = 1, **options) -> DataFrame:
    """Match, then match the leftovers again, `passes` times or (None) until nothing is added.

    A request that another one shadowed in one pass can be matched in the next.
    """
    if passes is not None and passes < 1:
        raise ValueError("passes must be positive")
    if passes == 1:
        return correlate(events, bp, **options)
    found, left, done = None, events, 0
    while passes is None or done < passes:
        pairs = cut_lineage(correlate(left, bp, **options))
        if pairs.isEmpty():
            return pairs if found is None else found
        found = pairs if found is None else found.unionByName(pairs)
        left = cut_lineage(pending(left, pairs))
        done += 1
    return found


def timeout_rows(unmatched: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Requests that have waited longer than `minutes` at `as_of`."""
    return unmatched.filter(
        (F.col("role") == REQUEST)
        & (F.unix_micros(as_of) - F.unix_micros("event_ts") > minutes * 60 * 1_000_000)
    )
