"""Splitting a key that is too large for one task.

A window over a key puts every row of the key into one task. Where a key may hold a large
share of the data, its rows are range-partitioned on (key, position) instead, so that the key
is spread over many *segments*, and the little state that must cross a segment border is
carried through a small summary (one row per key and segment).
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replylens.session import cut_lineage

SEGMENT = "_segment"
ROWS_PER_SEGMENT = 1_000_000
# A table of hot keys is broadcast up to this many rows; longer ones are joined by shuffle.
BROADCAST_KEYS = 100_000


@dataclass
class HotKeys:
    """The keys with more rows than a limit, as a table (key, _rows), and its size."""

    table: DataFrame
    keys: int
    rows: int

    def hinted(self, df: DataFrame) -> DataFrame:
        """A table with at most a row per hot key, for a join."""
        return F.broadcast(df) if self.keys <= BROADCAST_KEYS else df


def is_columnar_scan(df: DataFrame) -> bool:
    """Whether `df` only filters and projects columnar files, so that one of its columns is cheap to read again."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    nodes = [re.match(r"[\s:+\-]*(\w+)", line) for line in lines]
    files = all(re.search(r"\] (parquet|orc)$", line) for line in lines if " Relation [" in f" {line.lstrip(' :+-')}")
    return files and all(n and n[1] in ("Project", "Filter", "Union", "Relation") for n in nodes)


def find_hot_keys(df: DataFrame, key: str, min_rows: int) -> HotKeys:
    """All keys with more than `min_rows` rows. The count is combined map-side and reads the key column only."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > min_rows)
    counted = cut_lineage(counted)
    size = counted.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).first()
    return HotKeys(counted, size["keys"], size["rows"])


def split_by_keys(df: DataFrame, key: str, hot: HotKeys) -> tuple:
    """(rows of the hot keys, all other rows)."""
    listed = hot.hinted(hot.table.select(key))
    return df.join(listed, key, "left_semi"), df.join(listed, key, "left_anti")


def key_join(df: DataFrame, per_key: DataFrame, key: str, how: str, hot_rows: int | None) -> DataFrame:
    """Join `df` with a table that has at most one row per key, where one key may dominate `df`.

    Rows of hot keys stay where they are and get the few matching rows of `per_key` by broadcast
    (more than BROADCAST_KEYS of them by a shuffled join); all other rows take the ordinary join.
    """
    hot = None if hot_rows is None else find_hot_keys(df, key, hot_rows)
    if hot is None or not hot.keys:
        return df.join(per_key, key, how)
    heavy, rest = split_by_keys(df, key, hot)
    few, _ = split_by_keys(per_key, key, hot)
    return heavy.join(hot.hinted(few), key, how).unionByName(rest.join(per_key, key, how))


def segment_count(rows: int, rows_per_segment: int) -> int:
    return max(1, math.ceil(rows / rows_per_segment))


def into_segments(df: DataFrame, keys: list, position: list, segments: int) -> DataFrame:
    """Range-partition on (keys, position) and fix the partition number as a column.

    Rows of one key lie in ascending segments. The result is checkpointed, because the
    partition number must not change when a stage is run again.
    """
    ranged = df.repartitionByRange(segments, *keys, *position)
    return cut_lineage(ranged.withColumn(SEGMENT, F.spark_partition_id()))


def carry(
    df: DataFrame, keys: list, position: list, value: Column, name: str, backward=False, inclusive=True
) -> DataFrame:
    """Add `name`: the nearest non-NULL `value` at or before each row, per key.

    `backward` looks at the rows after instead; `inclusive=False` leaves the row itself out.
    Only one row per (key, segment) is windowed over the whole key.
    """
    order = [F.col(c).desc() if backward else F.col(c).asc() for c in position]
    inside = Window.partitionBy(SEGMENT, *keys).orderBy(*order)
    frame = inside.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    valued = df.withColumn("_value", value)
    # max_by / min_by skip rows whose ordering is NULL, so rows without a value do not count.
    rank = F.when(F.col("_value").isNotNull(), F.struct(*[F.col(c) for c in position]))
    edge = F.min_by if backward else F.max_by
    borders = valued.groupBy(SEGMENT, *keys).agg(edge("_value", rank).alias("_edge"))
    across = Window.partitionBy(*keys).orderBy(F.col(SEGMENT).desc() if backward else F.col(SEGMENT).asc())
    across = across.rowsBetween(Window.unboundedPreceding, -1)
    borders = borders.select(
        SEGMENT, *keys, F.last("_edge", ignorenulls=True).over(across).alias("_border")
    )
    joined = valued.withColumn("_inner", F.last("_value", ignorenulls=True).over(frame)).join(
        borders, [SEGMENT, *keys]
    )
    return joined.withColumn(name, F.coalesce("_inner", "_border")).drop("_value", "_inner", "_border")
