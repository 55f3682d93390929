"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Sources in code-point order (null last) take the weights in turn. The budget, a share of all sizes,
is divided by weight; a source's target stops at `max_repeats` times its size and the excess goes to
the others by weight until none is above. A document is expected rate = target / source size times.
Expected copies are prefix-summed over the documents of a source, one random offset per source is
added, and a document is taken once per integer boundary that its interval crosses.

Documents are summed in order of size, so that the words taken stay within about one large document
of the target. Prefix sums need no task per source: rows are range partitioned by (source, size,
doc_id), each partition counts its own rows, and a small table of (partition, source) counts is
prefix-summed.

Defined cases: null text has size 0; a null source is a source of its own, the last one; sources of
size 0 have target 0 and are not taken; documents of size 0 may be taken but add no words; rows that
repeat a doc_id are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replylens.llm.keeping import as_rows
from replylens.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))).substr(1, 8)
    return F.conv(digest, 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.0, max_repeats: int = 3) -> DataFrame:
    """(source, source_size, target) of `sized` (source, size).

    Sources below the water level are filled to their limit; `level` is what a unit of weight gets
    once they are taken out. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    taken_in_turn = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", taken_in_turn[(F.col("place") - 1) % len(weights)])
        .withColumn("limit", F.col("source_size") * F.lit(float(max_repeats)))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    levels = sources.withColumn(
        "level",
        (F.col("budget") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
    )
    level = F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(everything)
    return levels.withColumn("level", level).select(
        "source",
        "source_size",
        # Without a level every source is at its limit: the budget is more than all can give.
        F.least("limit", F.coalesce(F.col("weight") * F.col("level"), F.col("limit"))).alias("target"),
    )


def systematic_copies(
    sized: DataFrame, weights=WEIGHTS, share: float = 1.0, max_repeats: int = 3, seed: str = "mix"
) -> DataFrame:
    """`sized` (doc_id, source, size) with source_size, target and copies, one row per input row."""
    spark = sized.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written before it is range partitioned, which reads its input twice, to sample and to deal it.
    narrow = cut_lineage(sized.select("doc_id", "source", "size"))
    dealt = cut_lineage(
        narrow.repartitionByRange(parts, "source", "size", "doc_id")
        .withColumn("part", F.spark_partition_id())
    )
    targets = source_targets(dealt, weights, share, max_repeats)
    of_source = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = (
        dealt.groupBy("source", "part")
        .agg(F.count("*").alias("rows"))
        .withColumn("before", F.coalesce(F.sum("rows").over(of_source), F.lit(0)))
        .drop("rows")
    )
    # One row per partition and source in it, and one row per source.
    facts = parts_before.alias("p").join(
        targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))
    ).select("p.source", "p.part", "before", "source_size", "target")
    in_part = Window.partitionBy("part", "source").orderBy("size", "doc_id")
    placed = dealt.withColumn("rank", F.row_number().over(in_part)).alias("d")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = placed.join(
        facts.alias("f"), (F.col("d.part") == F.col("f.part")) & F.col("d.source").eqNullSafe(F.col("f.source"))
    ).select(
        "doc_id",
        "d.source",
        "size",
        "source_size",
        "target",
        rate.alias("rate"),
        (F.col("before") + F.col("rank")).alias("place"),
        offset(F.col("d.source"), seed).alias("offset"),
    )
    crossed = F.floor(F.col("rate") * F.col("place") + F.col("offset")) - F.floor(
        F.col("rate") * (F.col("place") - 1) + F.col("offset")
    )
    return joined.withColumn("copies", F.least(crossed, F.lit(max_repeats)).cast("long")).drop(
        "rate", "place", "offset"
    )


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row per document."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return systematic_copies(sized, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of `docs` as often as it is taken, with the columns of `docs`.

    Rows that share doc_id, source and size are numbered by their text; any other row, the rule, is
    joined without a window.
    """
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    keys = ["doc_id", "source", "size"]
    plan = (
        systematic_copies(sized, **options)
        .groupBy(*keys)
        .agg(F.count("*").alias("rows"), F.sum("copies").alias("copies"))
        .filter("copies > 0")
    )
    # One column holds a given row, so that its columns may have any names.
    rows = as_rows(docs).withColumn("words", word_count(F.col("row.text")))
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("doc_id"))
        & F.col("row.source").eqNullSafe(F.col("source"))
        & (F.col("words") == F.col("size"))
    )
    joined = rows.join(plan, same)
    once = joined.filter("rows = 1").withColumn("times", F.col("copies"))
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("row.text"))
    shared = (
        joined.filter("rows > 1")
        .withColumn("number", number)
        .withColumn("times", F.expr("copies div rows + int(number <= copies % rows)"))
        .drop("number")
        .filter("times > 0")
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return once.unionByName(shared).withColumn("copy", each).select("row.*")
