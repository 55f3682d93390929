"""Scalar expressions. All of them are built-in column functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the accepted instant form (UTC only, up to nanoseconds).
INSTANT_FORM = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?[Zz]$"


def field(name: str) -> Column:
    """A top-level column whose name may contain dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def once(df: DataFrame, columns: list) -> DataFrame:
    """Add columns that are computed once per row.

    The optimizer merges adjacent projections and moves filters below them, which repeats an
    expensive expression (a regular expression, a JSON parse) at each of its uses. It does not
    do so across a generator, and one over a single struct keeps one row per row.
    """
    return df.select(*[field(c) for c in df.columns], F.inline(F.array(F.struct(*columns))))


def strict_instant(text: Column) -> Column:
    """TIMESTAMP of an ISO instant in UTC; NULL for anything else."""
    return F.when(text.rlike(INSTANT_FORM), F.try_to_timestamp(F.upper(text)))


def hash_key(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts joined by `|`."""
    return F.sha2(F.concat_ws("|", *parts), 256)


def mask_pan(pan: Column) -> Column:
    """`****` and the last four characters; short numbers are hidden whole."""
    return F.when(F.length(pan) <= 4, F.lit("****")).otherwise(
        F.concat(F.lit("****"), F.right(pan, F.lit(4)))
    )


def latency_ms(start: Column, end: Column) -> Column:
    """Whole milliseconds from start to end, truncated toward zero."""
    elapsed = F.unix_micros(end) - F.unix_micros(start)
    return ((elapsed - elapsed % 1000) / 1000).cast("bigint")


def prefer_response(response: Column, request: Column, empty_as_null: bool = False) -> Column:
    """A dimension comes from the response if present there, else from the request.

    An empty string is a present value unless `empty_as_null` is set.
    """
    if empty_as_null:
        response = F.when(response != "", response)
        request = F.when(request != "", request)
    return F.coalesce(response, request)


def outcome(status: Column | None, success_values) -> Column:
    if status is None:
        return F.lit("UNKNOWN")
    success = status.isin(sorted(success_values)) if success_values else F.lit(False)
    return (
        F.when(status.isNull(), F.lit("UNKNOWN"))
        .when(success, F.lit("SUCCESS"))
        .otherwise(F.lit("ERROR"))
    )


def bucket_start(ts: Column, seconds: int) -> Column:
    """Start of the fixed-width time bucket that holds `ts`."""
    whole = F.unix_seconds(ts)
    return F.timestamp_seconds(whole - whole % F.lit(seconds).cast("bigint"))


def safe_ratio(part: Column, whole: Column) -> Column:
    """part / whole as DOUBLE; 0.0 when the base is empty."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole.cast("double"))


def round_half_up(value: Column) -> Column:
    """Round to the nearest integer, halves toward positive infinity."""
    return F.floor(value + F.lit(0.5))
