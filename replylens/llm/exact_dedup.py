"""Exact dedup by distributed MSD radix partitioning; no digest decides about equality.

The first digit of a text is its length in bytes with its first bytes, the next digits are runs of
the bytes that follow, each run longer than the last up to `WIDEST` bytes. A level counts rows per (group, digit), which
combines before the shuffle; groups of one row are done, groups whose bytes are used up are groups of
equal texts, and only the rest goes to the next level with the bytes that are left. Rows join their
group on (group, digit): a group with a third of all rows is a skewed join, which the adaptive
execution splits. Each level is written to the shared folder.

Defined cases: null text counts as empty; all empty texts are one group; rows that repeat a doc_id
are rows of their own, and of equal texts exactly one row is kept, of those with the largest doc_id;
a null doc_id is smaller than any other; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replylens.llm.keeping import only_kept
from replylens.session import cut_lineage

FIRST_DIGIT = 64
GROWTH = 16
WIDEST = 1 << 18  # bytes of a digit, so of a grouping key


def ascii_lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _level(rows: DataFrame, digit: Column, width: int, keys: list[str]) -> DataFrame:
    """Rows with the digit split off `rest`, and `group` null for rows that are alone in theirs."""
    rows = rows.withColumn("digit", digit)
    groups = cut_lineage(
        rows.groupBy(*keys, "digit")
        .agg(F.count("*").alias("members"))
        .filter("members > 1")
        .withColumn("next", F.monotonically_increasing_id())
    ).drop("members")
    joined = rows.join(groups.hint("merge"), [*keys, "digit"], "left")
    rest = F.when(F.col("next").isNotNull(), F.expr(f"substring(rest, {width + 1})"))
    return (
        joined.withColumn("rest", rest)
        .withColumn("ended", F.col("next").isNotNull() & (F.length("rest") == 0))
        .drop("digit")
        .withColumnRenamed("next", "group")
    )


def exact_groups(docs: DataFrame, first: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 and text_key of every row.

    text_sha256 is output only; text_key is xxhash64 of the text as it came.
    """
    normal = ascii_lower(F.col("text"))
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_key"), F.unhex(F.sha2(normal.cast("binary"), 256)).alias("sha"),
        normal.cast("binary").alias("rest"),
    ).withColumn("size", F.length("rest"))
    width = first
    state = cut_lineage(
        _level(rows, F.expr(f"substring(rest, 1, {width})"), width, ["size"])
        .withColumn("row_id", F.monotonically_increasing_id())
        .select("doc_id", "row_id", "text_key", "sha", "group", "ended", "rest")
    )
    levels = [state]
    while not state.filter("group IS NOT NULL AND NOT ended").isEmpty():
        width = min(width * growth, WIDEST)
        state = cut_lineage(
            _level(
                state.filter("group IS NOT NULL AND NOT ended").withColumnRenamed("group", "before"),
                F.expr(f"substring(rest, 1, {width})"), width, ["before"],
            ).select("doc_id", "row_id", "text_key", "sha", "group", "ended", "rest")
        )
        levels.append(state)
    singles, ended = [], []
    for depth, level in enumerate(levels):
        singles.append(level.filter("group IS NULL"))
        ended.append(level.filter("ended").withColumn("depth", F.lit(depth)))
    same = ended[0]
    for part in ended[1:]:
        same = same.unionByName(part)
    # Written, so that both sides of the join are plain exchanges and a hot group can be split.
    stays = cut_lineage(
        same.groupBy("depth", "group").agg(
            F.max(F.struct("doc_id", "row_id")).alias("stays"), F.count("*").alias("group_size")
        )
    )
    out = ("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"), "text_key")
    result = (
        same.join(stays.hint("merge"), ["depth", "group"])
        .withColumn("keep_id", F.col("stays.doc_id"))
        .withColumn("kept", F.col("row_id") == F.col("stays.row_id"))
        .select(*out)
    )
    for part in singles:
        alone = part.withColumn("keep_id", F.col("doc_id")).withColumn("kept", F.lit(True))
        result = result.unionByName(alone.withColumn("group_size", F.lit(1).cast("long")).select(*out))
    return result


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with its columns."""
    return only_kept(docs, exact_groups(docs))
