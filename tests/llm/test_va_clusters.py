import hashlib
import math
import random
from collections import Counter

import numpy as np

from rewardflow.llm.va_clusters import (
    Cells, assign, centroids_left, cluster_vectors, kept_vectors, make_cells, with_cells)

ROWS = "vec_id long, embedding array<float>, cluster string, distance int"


def brute(rows, dims, scale, count, rounds, seed):
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
            if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centroids = [g for _, g in sorted(((digest(i), g) for i, g in kept))[:count]]

    def nearest(g):
        return min((sum((a - b) ** 2 for a, b in zip(g, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        of = [nearest(g)[1] for _, g in kept]
        for k in range(len(centroids)):
            mine = [g for (_, g), c in zip(kept, of) if c == k]
            if mine:
                centroids[k] = [sum(col) // len(mine) for col in zip(*mine)]
    out = [(i, *nearest(g)) for i, g in kept]
    total = sum(d for _, d, _ in out)
    return Counter((i, k, d, sum(e for _, e, j in out if j == k), total,
                    hashlib.sha256(",".join(map(str, centroids[k])).encode()).hexdigest()) for i, d, k in out)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    centers = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.2))) for x in centers[i % 5]]) for i in range(300)]
    rows += [(3, rows[3][1])] * 40 + [(500, [0.0] * 6)] * 3 + [(None, [1.0] * 6), (None, [1.0] * 6)]
    rows += [(600, None), (601, []), (602, [1.0] * 5), (603, [1.0] * 7), (604, [1.0] * 5 + [None]),
             (605, [1.0] * 5 + [math.nan]), (606, [1.0] * 5 + [math.inf]), (607, [50000.0, *[0.0] * 5])]
    df = spark.createDataFrame([(i, e, "clash", 1) for i, e in rows], ROWS).repartition(4)
    want = brute(rows, 6, 64, 7, 3, 1)
    for bits in (3, 8):
        got = cluster_vectors(df, dims=6, count=7, bits=bits).collect()
        assert Counter(tuple(r)[:6] for r in got) == want
        if bits == 8:  # cells tell most vectors apart
            assert sum(r.in_full for r in got) < len(got) / 2


def test_few_none_and_huge_vectors(spark):
    assert cluster_vectors(spark.createDataFrame([], ROWS), dims=2).count() == 0
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 0.0])]
    got = cluster_vectors(spark.createDataFrame([(*r, None, None) for r in rows], ROWS), dims=2, count=16).collect()
    assert {(r.vec_id, r.distance) for r in got} == {(1, 0), (2, 0)} and len({r.cluster for r in got}) == 2


def test_same_vectors_only(spark):
    df = spark.createDataFrame([(i, [0.5, 0.25], "x", 0) for i in range(50)], ROWS)
    got = cluster_vectors(df, dims=2, count=4).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and len(got) == 50


def test_intervals_hold_and_full_vectors_only_where_they_overlap(spark):
    rng = np.random.default_rng(2)
    grid = rng.integers(-40, 40, (500, 8))
    cells = Cells(np.sort(rng.integers(-40, 40, (8, 7)), axis=1), grid.min(axis=0), grid.max(axis=0), 3)
    number = cells.number(grid)
    assert (cells.unpack(cells.pack(number)) == number).all()
    centroids = rng.integers(-40, 40, (5, 8))
    near, far = cells.bounds(centroids)
    d = ((grid[:, None, :] - centroids) ** 2).sum(axis=2)
    dims = np.arange(8)
    assert (near[dims, number].sum(axis=1) <= d).all() and (d <= far[dims, number].sum(axis=1)).all()
    left = centroids_left(cells, centroids)(cells.pack(number), step=64)
    assert left[np.arange(500), d.argmin(axis=1)].all()
    df = spark.createDataFrame([(i, (g / 64.0).tolist()) for i, g in enumerate(grid)],
                               "vec_id long, embedding array<double>")
    vectors = kept_vectors(df, 8)
    got = assign(with_cells(vectors, make_cells(vectors, 8, 3)), make_cells(vectors, 8, 3), centroids).collect()
    assert all(r.cluster == d[r.vec_id].argmin() for r in got)
