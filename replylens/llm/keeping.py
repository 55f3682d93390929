"""Rows that a decision per row leaves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_rows(docs: DataFrame) -> DataFrame:
    """`docs` as one column `row`, so that no technical column meets one of its own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def only_kept(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of `docs` that `decided` (doc_id, text_key, kept), one row per row of `docs`, keeps.

    text_key is xxhash64 of the text. Rows with the same id and text are one: if any is kept, one
    stays. Only exceptions are joined, by id and text, and always by a sort-merge join, whose cost
    grows evenly and which splits a hot id. Other columns may have any names.
    """
    marks = (
        decided.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
        .agg(F.count("*").alias("n"), F.max("kept").alias("any_kept"))
        .filter("n > 1 OR NOT any_kept")
    )
    same = F.col("row.doc_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    marked = as_rows(docs).withColumn("row_key", F.xxhash64("row.text")).join(marks.hint("merge"), same, "left")
    stay = marked.filter("n IS NULL")
    once = marked.filter("any_kept").dropDuplicates(["id", "key"])
    return stay.unionByName(once).select("row.*")
