"""Near vectors by int8 tiles against all pairs in double precision."""

import math

import numpy as np
import pytest
from rows import with_clashing_columns

from replylens.llm import tile_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)


def plain(rows, limit=0.9):
    """[(vec_id, n_links, component_id, kept)] of [(vec_id, vector)]."""
    links = [set() for _ in rows]
    vectors = [np.array(v, np.float32).astype(float) if usable(v) else None for _, v in rows]
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= limit:
                links[i].add(j)
                links[j].add(i)
    out = []
    for i, (vec_id, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((vec_id, len(links[i]), least, vec_id is not None and vec_id == least))
    return sorted(out, key=repr)


def table(spark, rows):
    made = [(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows]
    return spark.createDataFrame(made, SCHEMA)


def result(df, **options):
    return sorted(map(tuple, tile_dedup.near_vectors(df, **options).collect()), key=repr)


def clustered(rng, n, width, spread):
    """Groups whose inner similarity lies around 0.9, so that many pairs are near the limit."""
    centers = rng.normal(size=(max(1, n // 12), width))
    return centers[rng.integers(0, len(centers), n)] + spread * rng.normal(size=(n, width))


@pytest.mark.parametrize("width", [1, 3, 64, 1100])
def test_bounds_hold_for_every_pair(width):
    rng = np.random.default_rng(width)
    vectors = clustered(rng, 300, width, 0.33) * rng.choice([1e-30, 1, 1e30], (300, 1))
    q, bounds = tile_dedup.quantise(vectors)
    unit = vectors / np.sqrt((vectors**2).sum(axis=1))[:, None]
    exact = unit @ unit.T
    dots = q.astype(np.int64) @ q.astype(np.int64).T
    assert np.array_equal(tile_dedup.product(q, q), dots)
    s, m, e = bounds.T
    error = m[:, None] * e[None, :] + e[:, None] * m[None, :] + e[:, None] * e[None, :] + tile_dedup.SLACK
    assert (np.abs(exact - dots * s[:, None] * s[None, :]) <= error).all()
    i, j, sure = tile_dedup.decide(q, bounds, q, bounds, 0.9)
    decided = np.zeros(exact.shape, int)
    decided[i, j] = 1 + sure
    assert (exact[decided == 0] < 0.9).all() and (exact[decided == 2] >= 0.9).all()
    assert width < 64 or 0 < (decided == 1).sum() < 0.2 * exact.size


def test_stars_against_sets():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 30))
        pairs = {(i, j) for i, j in rng.integers(0, n, (int(rng.integers(0, 40)), 2)).tolist() if i < j}
        stars = tile_dedup.Stars(np.arange(100, 100 + n), np.arange(1, n + 1))
        listed = np.array(sorted(pairs), int).reshape(-1, 2)
        rng.shuffle(listed)
        for part in np.array_split(listed, 3):
            stars.add(part[:, 0], part[:, 1])
        group = {i: {i} for i in range(n)}
        for i, j in pairs:
            union = group[i] | group[j]
            for k in union:
                group[k] = union
        links = [sum((b + 1 if a == i else a + 1) for a, b in pairs if i in (a, b)) for i in range(n)]
        rows = {p: (c, r) for p, c, r in zip(*(v.tolist() for v in stars.rows().values()), strict=True)}
        assert rows == {100 + i: (links[i], 100 + min(group[i])) for i in range(n) if links[i]}


@pytest.mark.parametrize(("tile", "chunk"), [(16_384, 1024), (40, 16), (7, 3)])
def test_groups_around_the_limit(spark, tile, chunk):
    vectors = clustered(np.random.default_rng(7), 260, 16, 0.33)
    rows = [(i * 3 % 260, v.tolist()) for i, v in enumerate(vectors)]
    assert result(table(spark, rows), tile=tile, chunk=chunk) == plain(rows)


def test_hot_groups(spark):
    """A third of the rows are one vector, another third lies closely around it."""
    rng = np.random.default_rng(9)
    center = rng.normal(size=8)
    rows = [(i, center.tolist()) for i in range(0, 240, 3)]
    rows += [(i, (center + 0.02 * rng.normal(size=8)).tolist()) for i in range(1, 240, 3)]
    rows += [(i, rng.normal(size=8).tolist()) for i in range(2, 240, 3)]
    assert result(table(spark, rows), tile=50, chunk=20) == plain(rows)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 1.0]),
        (8, [2.0, 2.0]), (8, [2.0, 2.0]), (None, [3.0, 3.1]), (9, [1.0, 1.0, 0.0]), (10, [1.0, 1.0, 0.0]), (11, [-1.0, -1.0]),
        (12, [5.0]), (13, [0.1]), (14, [-3.0]), (None, None), (15, [0.0, -0.0]), (16, [1.0, -0.0]), (17, [1.0, 0.0]),
        (18, [1e-38, 1e-38]), (19, [3e38, 3e38]), (None, [7.0, -0.1, 3.0, 4.0]),
    ]
    given = with_clashing_columns(table(spark, rows))
    for name in ("point", "points", "tile", "other", "vec", "vec_hash", "copies", "component", "hash", "of", "links"):
        given = given.selectExpr("*", f"'x' AS {name}")
    assert result(given) == plain(rows)


def test_empty_table(spark):
    assert result(table(spark, [(1, [1.0])]).limit(0)) == []
    assert result(table(spark, [(1, None), (2, [0.0])])) == [(1, 0, 1, True), (2, 0, 2, True)]
