"""Connected components of an edge table, without a list of links or nodes outside of Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.session import cut_lineage

SALTS = 16


def _fingerprint(edges: DataFrame):
    """Count and sum of hashes of the rows: one row, combined per task."""
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    row = edges.agg(F.count("*").alias("n"), F.sum(mixed).alias("h")).first()
    return row.n, row.h


def salted(edges: DataFrame, per_node: DataFrame) -> DataFrame:
    """`edges` (u, v) joined with a row per u; the edges of one node are spread over SALTS tasks."""
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS))
    copies = per_node.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return edges.withColumn("salt", salt).join(copies, ["u", "salt"]).drop("salt")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge in `edges` (u, v); the component is its least node.

    Stars are contracted alternately: larger neighbours of a node are linked to its least neighbour,
    then smaller ones. Each step leaves at most as many edges as before, and the end is one star per
    component. The edges of a node with very many neighbours are salted.
    """
    stars = cut_lineage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )
    before = None
    while (now := _fingerprint(stars)) != before:
        before = now
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        linked = salted(large, lower)
        small = linked.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct())
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
