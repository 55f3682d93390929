"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Distinct vectors are dealt to tiles by a hash. A unit vector x is kept as scale s and int8 numbers q with
x = s q + e; the length of e is measured. For two vectors

    | x.y - s t (q.r) |  <=  |s q| |f| + |e| |t r| + |e| |f|

holds for every pair (r, t, f: numbers, scale and error of y), so an integer product decides most pairs: above the
limit by more than that bound, or below it by more. Integer products run as float32 matrix products, which are
exact for slices of `EXACT` components. The few pairs in between are computed in double precision from the
original vectors, which are fetched for them alone, at most once per pair of tiles.

Links are not written as pairs. A pair of tiles yields, for each of its vectors that has a link there, how many and the least
vector that it is connected with inside this pair of tiles; sums give the numbers of links, and the stars give the
components. A group of many near copies therefore makes rows by its members, not by its pairs. Equal vectors are one
vector with a count.

All pairs of tiles are multiplied: the work grows with the square of the number of distinct vectors, by 2 x
dimension float operations a pair, and each tile is sent to as many tasks as there are tiles. Nothing is
estimated and no link is lost. A task holds two tiles of `TILE` int8 vectors.

Defined cases: vectors that are null, zero, or hold null or non-finite components link with nothing; vectors
of different length do not link; repeated ids are vectors of their own; a null id is kept as it is, and the
component is the smallest id that is not null; rows that repeat are equal vectors; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replylens.llm.components import components
from replylens.session import cut_lineage

LIMIT = 0.9
CHUNK, TILE = 1024, 16_384
EXACT = 1024  # 127 * 127 * 1024 < 2 ** 24
SLACK = 1e-9  # far above the rounding of the bounds themselves
CHUNKS = "size int, tile int, chunk int, points binary, copies binary, numbers binary, bounds binary"
LINKED = "point long, n_links long, root long"
DECIDED = f"{LINKED}, size int, tile int, other int, needed array<long>, pairs binary"


def cosines(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Row by row in double precision; a power of two keeps squares in range and changes no digit."""

    def even(rows):
        return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])

    a, b = even(first), even(second)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 numbers, and per vector (scale, length of scale * numbers, length of the error), both from above."""
    even = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])
    unit = even / np.sqrt((even * even).sum(axis=1))[:, None]
    scale = np.abs(unit).max(axis=1) / 127
    numbers = np.rint(unit / scale[:, None]).clip(-127, 127)
    kept = numbers * scale[:, None]
    lengths = [np.sqrt((x * x).sum(axis=1)) + SLACK for x in (kept, unit - kept)]
    return numbers.astype(np.int8), np.stack([scale, *lengths], axis=1)


def product(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 rows."""
    if q.shape[1] <= EXACT:
        return q.astype(np.float32) @ r.astype(np.float32).T
    parts = range(0, q.shape[1], EXACT)
    return sum((q[:, a : a + EXACT].astype(np.float32) @ r[:, a : a + EXACT].astype(np.float32).T).astype(np.float64) for a in parts)


def decide(q, q_bounds, r, r_bounds, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, sure) of the pairs that may reach `limit`; `sure` ones are above it by more than the error."""
    dots = product(q, r)
    widest = q_bounds[:, 1] * r_bounds[:, 2].max() + q_bounds[:, 2] * (r_bounds[:, 1].max() + r_bounds[:, 2].max())
    # float32 rounds by less than 1e-6 of a product of at most about 1.
    least = ((limit - widest - 1e-5) / q_bounds[:, 0]).astype(np.float32)
    i, j = np.nonzero(dots * r_bounds[:, 0].astype(np.float32)[None, :] >= least[:, None])
    (s, m, e), (t, n, f) = q_bounds[i].T, r_bounds[j].T
    about = dots[i, j].astype(np.float64) * s * t
    error = m * f + e * n + e * f + SLACK
    near = about + error >= limit
    return i[near], j[near], (about - error >= limit)[near]


class Stars:
    """Numbers of links and connected components of the vectors of one task."""

    def __init__(self, points: np.ndarray, copies: np.ndarray):
        self.points, self.copies = points, copies
        self.links = np.zeros(len(points), np.int64)
        self.label = np.arange(len(points))

    def add(self, i: np.ndarray, j: np.ndarray):
        """Links between different places i and j, each link once."""
        np.add.at(self.links, i, self.copies[j])
        np.add.at(self.links, j, self.copies[i])
        while len(i):
            a, b = self.label[i], self.label[j]
            open_ = a != b
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            if not len(i):
                break
            low, high = np.minimum(a, b), np.maximum(a, b)
            # Every larger label goes to its least neighbour; chains are followed to their end.
            to = np.arange(len(self.label))
            np.minimum.at(to, high, low)
            while True:
                further = to[to]
                if (further == to).all():
                    break
                to = further
            self.label = to[self.label]

    def rows(self) -> dict[str, np.ndarray]:
        linked = self.links > 0
        least = np.full(len(self.points), np.iinfo(np.int64).max)
        np.minimum.at(least, self.label, self.points)
        return {"point": self.points[linked], "n_links": self.links[linked], "root": least[self.label][linked]}


def _numbers(value: bytes, kind, width: int | None = None) -> np.ndarray:
    out = np.frombuffer(value, kind)
    return out if width is None else out.reshape(-1, width)


def distinct_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame]:
    """All rows (vec_id, vec_hash, vec; vec null if it takes no part) and the distinct vectors among them."""
    vec = F.col("vec")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    counts = F.coalesce(finite & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{vector_column}`").cast("array<double>").alias("vec"))
    # x + 0.0 makes a negative zero positive, so that equal vectors are equal as bytes too.
    rows = rows.withColumn("vec", F.when(counts, F.transform(vec, lambda x: x + F.lit(0.0))))
    rows = rows.withColumn("vec_hash", F.when(F.col("vec").isNotNull(), F.xxhash64("vec")))
    points = (
        rows.filter(F.col("vec").isNotNull())
        .groupBy("vec_hash", "vec")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
        .withColumn("point", F.monotonically_increasing_id())
    )
    return rows, cut_lineage(points)


def linked_rows(points: DataFrame, limit: float, tile: int, chunk: int) -> DataFrame:
    """LINKED rows of all pairs of `points` (point, vec, copies) with a cosine of at least `limit`."""
    spark = points.sparkSession
    sizes = points.count()
    # Enough pairs of tiles to keep all tasks busy, few enough to fill tiles.
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tiles = max(-(-sizes // tile), min(int(np.ceil(np.sqrt(2 * parallel))), -(-sizes // chunk)), 1)

    def pack(key, group):
        import pandas as pd

        made = []
        for start in range(0, len(group), chunk):
            part = group.iloc[start : start + chunk]
            numbers, bounds = quantise(np.stack(part["vec"].to_numpy()))
            ids = (part[c].to_numpy(np.int64).tobytes() for c in ("point", "copies"))
            made.append((*key, start // chunk, *ids, numbers.tobytes(), bounds.tobytes()))
        return pd.DataFrame(made, columns=[f.split()[0] for f in CHUNKS.split(", ")])

    dealt = points.select(
        F.size("vec").alias("size"), F.pmod(F.xxhash64("vec_hash"), F.lit(tiles)).cast("int").alias("tile"), "point", "copies", "vec"
    )
    chunks = cut_lineage(dealt.groupBy("size", "tile").applyInPandas(pack, CHUNKS))
    first = chunks.withColumn("other", F.explode(F.sequence("tile", F.lit(tiles - 1))))
    second = chunks.withColumn("other", F.col("tile")).withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("other"))))

    def multiply(key, left, right):
        import pandas as pd

        width, tile, other = key
        names = [f.split()[0] for f in DECIDED.split(", ")]
        if not len(left) or not len(right):
            return pd.DataFrame(columns=names)
        sides = [left] if tile == other else [left, right]
        points, copies = (_numbers(b"".join(b"".join(side[c]) for side in sides), np.int64) for c in ("points", "copies"))
        stars, unsure, parts, at = Stars(points, copies), [], [], 0
        for side in sides:
            parts.append([])
            for row in side.itertuples():
                bounds = _numbers(row.bounds, np.float64, 3)
                parts[-1].append((row.chunk, at, _numbers(row.numbers, np.int8, width), bounds))
                at += len(bounds)
        for a, first_at, q, q_bounds in parts[0]:
            for b, second_at, r, r_bounds in parts[-1]:
                if tile == other and b < a:
                    continue
                i, j, sure = decide(q, q_bounds, r, r_bounds, limit)
                if tile == other and a == b:
                    once = i < j
                    i, j, sure = i[once], j[once], sure[once]
                stars.add(first_at + i[sure], second_at + j[sure])
                if not sure.all():
                    pairs = points[np.stack([first_at + i[~sure], second_at + j[~sure]], axis=1)]
                    unsure.append({"needed": np.unique(pairs), "pairs": pairs.tobytes()})
        made = list(zip(*(c.tolist() for c in stars.rows().values()), *[[None] * len(points)] * 5, strict=False))
        made += [(None, None, None, width, tile, other, u["needed"], u["pairs"]) for u in unsure]
        return pd.DataFrame(made, columns=names, dtype=object)

    keys = ("size", "tile", "other")
    decided = cut_lineage(first.groupBy(*keys).cogroup(second.groupBy(*keys)).applyInPandas(multiply, DECIDED))

    def recompute(key, listed, fetched):
        import pandas as pd

        fetched = fetched.sort_values("point")
        points, vectors = fetched["point"].to_numpy(), np.stack(fetched["vec"].to_numpy())
        stars = Stars(points, fetched["copies"].to_numpy())
        for pairs in listed["pairs"]:
            i, j = np.searchsorted(points, _numbers(pairs, np.int64, 2)).T
            steps = range(0, len(i), chunk)
            linked = np.concatenate([cosines(vectors[i[k : k + chunk]], vectors[j[k : k + chunk]]) >= limit for k in steps])
            stars.add(i[linked], j[linked])
        return pd.DataFrame(stars.rows())

    unsure = decided.filter("pairs IS NOT NULL")
    # toDF gives the columns identities of their own, which cogroup needs.
    needed = unsure.select(*keys, F.explode("needed").alias("point")).distinct().toDF(*keys, "point")
    needed = needed.join(points.select("point", "copies", "vec"), "point")
    confirmed = unsure.select(*keys, "pairs").groupBy(*keys).cogroup(needed.groupBy(*keys)).applyInPandas(recompute, LINKED)
    return decided.filter("pairs IS NULL").select("point", "n_links", "root").unionByName(confirmed)


def near_vectors(
    vectors: DataFrame, limit: float = LIMIT, id_column: str = "vec_id", vector_column: str = "embedding",
    tile: int = TILE, chunk: int = CHUNK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows, points = distinct_vectors(vectors, id_column, vector_column)
    linked = cut_lineage(linked_rows(points, limit, tile, chunk))
    links = linked.groupBy("point").agg(F.sum("n_links").alias("others"))
    edges = linked.filter("point <> root").select(F.col("point").alias("u"), F.col("root").alias("v"))
    found = components(edges).withColumnRenamed("node", "point")
    named = (
        points.select("point", "vec_hash", "vec", "first_id", "copies")
        .join(links, "point", "left")
        .join(found, "point", "left")
        .withColumn("component", F.coalesce("component", "point"))
    )
    least = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    # Written, so that a vector with very many copies is a skewed join that the adaptive execution splits.
    decided = cut_lineage(
        named.join(least, "component").select(
            F.col("vec_hash").alias("hash"), F.col("vec").alias("of"), "component_id",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    own = F.col("vec_id")
    return (
        rows.join(decided.hint("merge"), (F.col("vec_hash") == F.col("hash")) & (F.col("vec") == F.col("of")), "left")
        .withColumn("component_id", F.coalesce("component_id", own))
        .select(
            own,
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            "component_id",
            F.coalesce(own == F.col("component_id"), F.lit(False)).alias("kept"),
        )
    )
