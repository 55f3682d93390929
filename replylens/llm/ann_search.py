"""Nearest neighbours by largest inner product with an inverted multi-index.

Each half of a vector is quantised by a codebook of its own; a pair of centroids is a cell. For a query
the centroids of each half are sorted by their inner product with the query's half, and cells are
visited by the sum of both with a heap (multi-sequence traversal) until they hold a given share of all
vectors. What lies in them is reranked by the exact inner product in double precision.

Equal vectors have equal scores, and ties go to smaller ids, so of equal vectors only the k + 1
smallest ids can be in a result of k besides the query itself: vectors are indexed once with those
ids, however many copies there are. Equal queries are searched once.

The codebooks are fitted on `SAMPLE` vectors, and so is the share to visit: the least for which
`RECALL` of the true neighbours within the sample are found. Every vector is indexed. Cells are laid out
in shards of about `SHARD` vectors, cells that are larger over several; a query goes to the shards of its
cells, in blocks of about `QUERIES` queries. So a group is bounded by SHARD and QUERIES. The driver
holds the codebooks and one number per cell, at most CENTROIDS ** 2.

Defined cases: vectors that are null or zero or hold null or non-finite components take no part, and neither
do null ids; vectors of different lengths are not compared; repeated ids are separate
candidates, but a query never finds its own id; without vectors the result is empty; other columns
are ignored.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from replylens.session import cut_lineage

SAMPLE, RECALL = 20_000, 0.96
CENTROIDS, PER_CELL = 256, 16
SHARD, QUERIES = 8192, 4096
ROUNDS, TRIALS = 12, 400
OUT = "query_id long, rank int, vec_id long, score double"


class MultiIndex:
    """Codebooks of both halves and the share of vectors to visit."""

    def __init__(self, sample: np.ndarray, n_vectors: int, k: int, seed: int = 0, recall: float = RECALL):
        rng = np.random.default_rng(seed)
        size = int(np.clip(np.sqrt(n_vectors / PER_CELL), 1, CENTROIDS))
        self.half = sample.shape[1] // 2
        self.books = [self.fit(part, min(size, len(sample)), rng) for part in self.halves(sample)]
        self.width = len(self.books[1])
        self.share = self.share_for(sample, k, rng, recall)

    def halves(self, vectors: np.ndarray):
        return vectors[:, : self.half], vectors[:, self.half :]

    @staticmethod
    def nearest(vectors: np.ndarray, book: np.ndarray) -> np.ndarray:
        return np.argmax(vectors @ book.T - 0.5 * (book * book).sum(axis=1), axis=1)

    def fit(self, vectors: np.ndarray, size: int, rng) -> np.ndarray:
        book = vectors[rng.choice(len(vectors), size, replace=False)].copy()
        for _ in range(ROUNDS):
            owner = self.nearest(vectors, book)
            counts = np.bincount(owner, minlength=size)
            sums = np.zeros_like(book)
            np.add.at(sums, owner, vectors)
            book[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
        return book

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        first, second = (self.nearest(v, b) for v, b in zip(self.halves(vectors), self.books, strict=True))
        return first * self.width + second

    def visit(self, query: np.ndarray, occupied: np.ndarray, wanted: float) -> list[int]:
        """Occupied cells by summed inner product until they hold `wanted` vectors."""
        scores = [b @ q for q, b in zip((query[: self.half], query[self.half :]), self.books, strict=True)]
        order = [np.argsort(-s, kind="stable") for s in scores]
        one, two = (s[o].tolist() for s, o in zip(scores, order, strict=True))
        cells, held = [], 0
        heap, reached = [(-(one[0] + two[0]), 0, 0)], {(0, 0)}
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(order[0][i]) * self.width + int(order[1][j])
            if occupied[cell]:
                cells.append(cell)
                held += int(occupied[cell])
            for a, b in ((i + 1, j), (i, j + 1)):
                if a < len(one) and b < len(two) and (a, b) not in reached:
                    reached.add((a, b))
                    heapq.heappush(heap, (-(one[a] + two[b]), a, b))
        return cells

    def share_for(self, sample: np.ndarray, k: int, rng, recall: float) -> float:
        """The share of the sample that must be visited to find `recall` of the true neighbours."""
        cells = self.cells(sample)
        occupied = np.bincount(cells, minlength=len(self.books[0]) * self.width)
        needed = []
        for q in rng.choice(len(sample), min(TRIALS, len(sample)), replace=False):
            exact = sample @ sample[q]
            exact[q] = -np.inf
            best = np.argsort(-exact)[: min(k, len(sample) - 1)]
            one, two = (b @ h for b, h in zip(self.books, (sample[q, : self.half], sample[q, self.half :]), strict=True))
            order = np.argsort(-(one[:, None] + two[None, :]).ravel(), kind="stable")
            held = np.empty(len(order))
            held[order] = np.cumsum(occupied[order])
            needed += (held[cells[best]] / len(sample)).tolist()
        return float(np.quantile(needed, recall, method="higher")) if needed else 1.0


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vec, vec_hash) of the vectors that take part; vec holds doubles."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & vec.isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    # x + 0.0 makes a negative zero positive, so that equal vectors are equal as bytes too.
    rows = rows.filter(F.exists(vec, lambda x: x != 0)).withColumn("vec", F.transform(vec, lambda x: x + F.lit(0.0)))
    return rows.withColumn("vec_hash", F.xxhash64("vec"))


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """(point, vec, ids): distinct vectors with their `keep` smallest ids, cut down before the shuffle."""
    same = Window.partitionBy("vec_hash", "vec").orderBy("vec_id")
    return (
        rows.withColumn("n", F.row_number().over(same))
        .filter(F.col("n") <= keep)
        .groupBy("vec_hash", "vec")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.monotonically_increasing_id().alias("point"), "vec", "ids")
    )


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _layout(occupied: np.ndarray, shard: int):
    """First shard and number of shards per cell; small cells share one in cell order."""
    pieces = np.maximum(1, -(-occupied // shard))
    first = np.zeros(len(occupied), np.int64)
    at, room = 0, shard
    for cell in np.flatnonzero(occupied):
        n = int(occupied[cell])
        if pieces[cell] > 1 or n > room:
            at, room = at + 1, shard
        first[cell] = at
        if pieces[cell] > 1:
            at, room = at + int(pieces[cell]), shard
        else:
            room -= n
    return first, pieces


def search(
    vectors: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
    sample: int = SAMPLE, recall: float = RECALL, shard: int = SHARD, per_block: int = QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id, score: for rows with `is_query` the k nearest of all other rows.

    Vectors of different lengths have no inner product: every length has an index of its own. One row
    per length comes to the driver.
    """
    points = cut_lineage(distinct_points(usable(vectors, id_column, vector_column), k + 1))
    asked = usable(vectors.filter(is_query), id_column, vector_column)
    lengths = [r.n for r in asked.groupBy(F.size("vec").alias("n")).agg(F.lit(1)).orderBy("n").collect()]
    if not lengths:
        return vectors.sparkSession.createDataFrame([], OUT)
    parts = []
    for length in lengths:
        of_length = F.size("vec") == length
        parts.append(_search(points.filter(of_length), asked.filter(of_length), k, sample, recall, shard, per_block))
    return reduce(DataFrame.unionByName, parts)


def _search(points: DataFrame, asked: DataFrame, k: int, sample: int, recall: float, shard: int, per_block: int) -> DataFrame:
    """`search` among `points` for `asked`, all of one length."""
    spark = points.sparkSession
    # Spark keeps `sample` rows only; their order is a hash of the vector.
    drawn = points.orderBy(F.xxhash64("vec"), "point").limit(sample).select("vec").toArrow().column(0)
    index = MultiIndex(_matrix(drawn.combine_chunks()), points.count(), k, recall=recall)
    shared = spark.sparkContext.broadcast(index)

    def to_cells(batches):
        import pyarrow as pa

        for batch in batches:
            cells = shared.value.cells(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=["point", "vec", "ids", "cell"])

    indexed = cut_lineage(points.mapInArrow(to_cells, "point long, vec array<double>, ids array<long>, cell int"))
    counts = indexed.groupBy("cell").count().toPandas()
    occupied = np.zeros(len(index.books[0]) * index.width, np.int64)
    occupied[counts["cell"]] = counts["count"]
    first, pieces = _layout(occupied, shard)
    layout = spark.sparkContext.broadcast((occupied, first, pieces))
    wanted = max(index.share * occupied.sum(), min(occupied.sum(), k + 1))

    questions = cut_lineage(
        asked.groupBy("vec_hash", "vec").agg(F.count("*").alias("n")).select(F.monotonically_increasing_id().alias("question"), "vec_hash", "vec")
    )

    def own_cells(batches):
        import pyarrow as pa

        for batch in batches:
            cells = shared.value.cells(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=["question", "vec", "own_cell"])

    opened = cut_lineage(questions.select("question", "vec").mapInArrow(own_cells, "question long, vec array<double>, own_cell int"))
    # Questions of the same cells visit much the same shards, so they share a block.
    per_cell = opened.groupBy("own_cell").count().toPandas()
    begun = np.zeros(len(occupied), np.int64)
    begun[per_cell["own_cell"]] = per_cell["count"]
    blocks = spark.sparkContext.broadcast(_layout(begun, per_block))

    def to_shards(batches):
        import pyarrow as pa

        occupied, first, pieces = layout.value
        block, of_cell = blocks.value
        for batch in batches:
            vecs, numbers, cells = _matrix(batch.column(1)), batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for number, vec, begin, item in zip(numbers, vecs, cells, range(batch.num_rows), strict=True):
                by_shard: dict[int, list[int]] = {}
                for cell in shared.value.visit(vec, occupied, wanted):
                    for piece in range(int(pieces[cell])):
                        by_shard.setdefault(int(first[cell]) + piece, []).append(cell)
                shards = sorted(by_shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shards, pa.int32()),
                        pa.array([int(block[begin]) + number % int(of_cell[begin])] * len(shards), pa.int32()),
                        pa.array([number] * len(shards), pa.int64()),
                        batch.column(1).take(pa.array([item] * len(shards), pa.int32())),
                        pa.array([by_shard[s] for s in shards], pa.list_(pa.int32())),
                    ],
                    names=["shard", "block", "question", "vec", "cells"],
                )

    # A traversal is work for a task, however few bytes the questions have.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = cut_lineage(
        opened.repartition(tasks, "question").mapInArrow(to_shards, "shard int, block int, question long, vec array<double>, cells array<int>")
    )

    def place(batches):
        import pyarrow as pa

        _, first, pieces = layout.value
        for batch in batches:
            cell, point = batch.column(3).to_numpy(), batch.column(0).to_numpy()
            shards = first[cell] + point % pieces[cell]
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), *batch.columns], names=["shard", "point", "vec", "ids", "cell"])

    placed = indexed.mapInArrow(place, "shard int, point long, vec array<double>, ids array<long>, cell int")
    # A shard goes only to the blocks with a question that visits it.
    entries = placed.join(spread.select("shard", "block").distinct().toDF("shard", "block"), "shard")

    def rerank(asking, held):
        import pandas as pd

        found = {"question": [], "score": [], "ids": []}
        if len(held) and len(asking):
            matrix, cell = np.stack(held["vec"].to_numpy()), held["cell"].to_numpy()
            ids = held["ids"].to_numpy()
            smallest = np.array([i[0] for i in ids])
            names, place_of = np.unique(cell, return_inverse=True)
            for question, vec, cells in zip(asking["question"], asking["vec"], asking["cells"], strict=True):
                mine = np.flatnonzero(np.isin(names, cells)[place_of])
                rough = matrix[mine] @ vec
                if len(mine) > k + 1:
                    least = np.partition(rough, -(k + 1))[-(k + 1)]
                    mine = mine[rough >= least - 1e-9 * (1 + abs(least))]
                # A sum that depends on the two vectors alone, whatever else is in the group.
                score = (matrix[mine] * vec).sum(axis=1)
                best = np.lexsort((smallest[mine], -score))[: k + 1]
                found["question"] += [question] * len(best)
                found["score"] += score[best].tolist()
                found["ids"] += ids[mine[best]].tolist()
        return pd.DataFrame(found)

    hits = (
        spread.groupBy("shard", "block")
        .cogroup(entries.groupBy("shard", "block"))
        .applyInPandas(rerank, "question long, score double, ids array<long>")
        .select("question", "score", F.explode("ids").alias("vec_id"))
    )
    best = Window.partitionBy("question").orderBy(F.desc("score"), "vec_id")
    top = hits.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")
    lists = cut_lineage(top.groupBy("question").agg(F.collect_list(F.struct("score", "vec_id")).alias("found")))
    owners = asked.join(questions.select("question", "vec_hash", F.col("vec").alias("asked_vec")), "vec_hash").filter(
        F.col("vec") == F.col("asked_vec")
    )
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        owners.select(F.col("vec_id").alias("query_id"), "question")
        .distinct()
        .join(lists, "question")
        .select("query_id", F.inline("found"))
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
