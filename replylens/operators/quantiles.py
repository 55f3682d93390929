"""Exact quantiles per group, without sorting a group's rows in one task.

Rows are first counted per (group, value), which combines map-side. A group then has at most
as many rows as distinct values. If that number is too large for one task, ranks are found by radix
selection: a level of DIGIT cells at a time, each counted map-side, and only the cells that hold a wanted
rank are opened. So no task handles more than a fixed number of rows of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replylens.session import cut_lineage

# Distinct values per group that one task may rank.
MAX_VALUES = 65_536
DIGIT = 4096


def nearest_rank(q: float):
    """1-based rank ceil(q * n), at least 1."""
    return lambda n: F.greatest(F.lit(1).cast("bigint"), F.ceil(F.lit(float(q)) * n))


def floor_index(percent: float):
    """1-based rank of the 0-based index floor(percent / 100 * n)."""
    return lambda n: F.floor(F.lit(percent / 100.0) * n) + 1


def clamped_floor_index(percent: float):
    return lambda n: F.least(floor_index(percent)(n), n)


def value_counts(df: DataFrame, groups: list, value: str, weights: dict | None = None) -> DataFrame:
    """(groups, value, n, weights): one row per distinct value; `weights` are summed columns."""
    sums = [F.sum(expr.cast("bigint")).alias(name) for name, expr in (weights or {}).items()]
    return df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("n"), *sums)


def summarise(
    counts: DataFrame,
    groups: list,
    value: str,
    ranks: dict,
    weights: list | None = None,
    max_values: int | None = None,
    per_task: int = MAX_VALUES,
) -> DataFrame:
    """(groups, n, total, low, high, weights, one column per rank) from `value_counts` rows.

    `ranks` maps a column name to a function of the group size that gives a 1-based rank.
    `max_values` is a proven bound on the distinct values of a group, if there is one. Without
    one that fits `per_task`, the counts are written once and the largest group is measured.
    """
    weights = weights or []
    stats = [
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        *[F.sum(w).alias(w) for w in weights],
    ]
    if max_values is None or max_values > per_task:
        counts = cut_lineage(counts)
        sizes = counts.groupBy(*groups).agg(F.count(F.lit(1)).alias("size"))
        max_values = sizes.agg(F.max("size")).first()[0] or 0
    rows = counts.withColumns(
        {"total": F.col(value) * F.col("n"), "low": F.col(value), "high": F.col(value)}
    )
    if max_values <= per_task:
        ranked = _ranked(rows, groups, value)
        hits = [F.max(F.when(_hit(rank), F.col(value))).alias(name) for name, rank in ranks.items()]
        return ranked.groupBy(*groups).agg(*stats, *hits)

    whole = rows.groupBy(*groups).agg(*stats)
    picked = _by_digits(counts, whole.select(*groups, "n", "low", "high"), groups, value, ranks)
    # Without groups, both sides are one row.
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups] or [F.col("n").isNotNull() == F.col("_one")]
    renamed = picked.select(*[F.col(g).alias(f"_{g}") for g in groups], *ranks, F.lit(True).alias("_one"))
    return whole.join(renamed, same, "left").drop("_one", *[f"_{g}" for g in groups])


def _by_digits(counts: DataFrame, whole: DataFrame, groups: list, value: str, ranks: dict) -> DataFrame:
    """(groups, one column per rank): radix selection, a digit of DIGIT values per level.

    A level counts rows per (group, cell so far, digit), which combines map-side, finds the digit that holds
    each wanted rank from these at most DIGIT counts, and goes on with the values of those cells only.
    """
    low, high = whole.agg(F.min("low"), F.max("high")).first()
    if low is None:
        low = high = 0
    width, levels = 1, 1
    while width * DIGIT <= high - low:
        width, levels = width * DIGIT, levels + 1
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("bigint").alias("rank")) for name, rank in ranks.items()]))
    wanted = whole.select(*[F.col(g).alias(f"_{g}") for g in groups], each.alias("w"), F.lit(0).cast("bigint").alias("_cell"))
    wanted = wanted.select(*[f"_{g}" for g in groups], "w.name", "w.rank", "_cell")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups] + [F.col("cell") == F.col("_cell")]
    place = f"(`{value}` - ({low}L))"
    for level in range(levels):
        cell = F.expr(f"{place} div {width * DIGIT}L") if level else F.lit(0).cast("bigint")
        cells = counts.select(*groups, "n", cell.alias("cell"), F.expr(f"{place} div {width}L").alias("next"))
        open_ = wanted.select(*[f"_{g}" for g in groups], "_cell").distinct()
        inside = cells.join(open_, same, "left_semi").groupBy(*groups, "cell", "next").agg(F.sum("n").alias("n"))
        before = Window.partitionBy(*groups, "cell").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        placed = inside.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        hit = (F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("before") + F.col("n"))
        # Written, so that a level starts from what the last one found.
        wanted = cut_lineage(
            placed.join(wanted, same)
            .filter(hit)
            .select(*[f"_{g}" for g in groups], "name", (F.col("rank") - F.col("before")).alias("rank"), F.col("next").alias("_cell"))
        )
        width //= DIGIT
    found = [F.max(F.when(F.col("name") == name, F.col("_cell") + F.lit(low).cast("bigint"))).alias(name) for name in ranks]
    return wanted.groupBy(*[F.col(f"_{g}").alias(g) for g in groups]).agg(*found)


def _ranked(rows: DataFrame, groups: list, value: str) -> DataFrame:
    """Add `before` (rows of the group with a smaller value) and `size` (rows of the group)."""
    w = Window.partitionBy(*groups).orderBy(value)
    return rows.withColumn(
        "before", F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).withColumn(
        "size", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )


def _hit(rank) -> Column:
    wanted = rank(F.col("size"))
    return (F.col("before") < wanted) & (wanted <= F.col("before") + F.col("n"))
