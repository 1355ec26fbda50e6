"""Centroid clustering through a VA-file (vector approximation file).

Vectors are integer grids of their components. Beside each vector stands its
approximation: one few-bit cell number per dimension, packed. For a set of centroids
a lookup table holds, per dimension, cell and centroid, the least and greatest squared
difference a component in that cell can have; adding up the entries of a vector's
cells gives an interval for its distance to every centroid. A centroid whose interval
starts beyond the least upper end cannot be nearest. A vector with one centroid left is
assigned by its cells alone; only vectors whose intervals overlap are handed on in
full, and then compared with the centroids left. Cell borders are quantiles of a
bounded sample, the outer cells reach to the exact extremes of all vectors, so the
intervals hold for every vector and assignments are exact.

Centroid updates are sums and counts per cluster, added up map-side; the driver holds
the centroids and nothing else.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, Shared

BITS, SAMPLE = 6, 4096
#: grid components beyond this are set to it, so that squared distances fit 64 bits
REACH = 1 << 27


def kept_vectors(table: DataFrame, dims: int = 64, scale: int = 64) -> DataFrame:
    """vec_id and ``grid`` (array of long) of the rows with exactly ``dims`` finite components."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    grid = F.transform(e, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(REACH))),
                                                       F.lit(-float(REACH)))).cast("long"))
    return table.select("vec_id", F.when((F.size(e) == dims) & ~bad, grid).alias("grid")).where("grid is not null")


def first_centroids(rows: DataFrame, count: int, seed: int) -> np.ndarray:
    """The vectors with the smallest sha256 of ``<seed>:<vec_id>`` (a NULL id: empty), ties by
    the vector itself."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    got = rows.select(F.sha2(text, 256).alias("h"), "grid").orderBy("h", "grid").limit(count).collect()
    return np.array([r.grid for r in sorted(got, key=lambda r: (r.h, r.grid))], dtype=np.int64)


@dataclass
class Cells:
    """``borders[d]``: the first grid value of each cell but the lowest; ``low`` and ``high``:
    the extremes of each dimension over all vectors."""

    borders: np.ndarray
    low: np.ndarray
    high: np.ndarray
    bits: int

    def number(self, grid: np.ndarray) -> np.ndarray:
        """Cell numbers (vectors x dimensions)."""
        return np.stack([np.searchsorted(b, grid[:, d], side="right")
                         for d, b in enumerate(self.borders)], axis=1).astype(np.uint8)

    def pack(self, cells: np.ndarray) -> np.ndarray:
        low_bits = np.unpackbits(cells[..., None], axis=2)[..., 8 - self.bits:]
        return np.packbits(low_bits.reshape(len(cells), -1), axis=1)

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        dims = len(self.borders)
        low_bits = np.unpackbits(packed, axis=1)[:, :dims * self.bits].reshape(len(packed), dims, self.bits)
        return np.packbits(np.pad(low_bits, ((0, 0), (0, 0), (8 - self.bits, 0))), axis=2)[..., 0]

    def bounds(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest squared difference by dimension, cell and centroid."""
        least = np.concatenate([self.low[:, None], self.borders], axis=1)[..., None]
        most = np.concatenate([self.borders - 1, self.high[:, None]], axis=1)[..., None]
        c = centroids.T[:, None, :]
        near = np.maximum(0, np.maximum(least - c, c - most))
        far = np.maximum(np.abs(least - c), np.abs(most - c))
        return near ** 2, far ** 2


def make_cells(rows: DataFrame, dims: int, bits: int = BITS, sample: int = SAMPLE) -> Cells:
    """Cell borders at the quantiles of the different values in at most ``sample`` vectors (those
    with the smallest hash), extremes over all vectors. To the driver: the sample and two numbers a dimension."""
    def extremes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = np.full(dims, REACH), np.full(dims, -REACH)
        for f in frames:
            if len(f):
                grid = np.stack(f["grid"].to_numpy())
                low, high = np.minimum(low, grid.min(axis=0)), np.maximum(high, grid.max(axis=0))
        yield pd.DataFrame({"d": np.arange(dims, dtype=np.int32), "low": low, "high": high})

    ends = (rows.select("grid").mapInPandas(extremes, "d int, low long, high long")
            .groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect())
    # hashes first, so that a task hands on numbers and not vectors
    hashed = rows.select(F.xxhash64("grid").alias("h"), "grid")
    last = hashed.select("h").orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    got = hashed.where(F.col("h") <= last).select("grid").distinct().collect()
    values = [np.unique(v) for v in np.array([r.grid for r in got], dtype=np.int64).T]
    borders = np.stack([v[(np.arange(1, 1 << bits) * len(v)) >> bits] for v in values])
    low, high = (np.array([r[k] for r in ends], dtype=np.int64) for k in ("low", "high"))
    return Cells(borders, low, high, bits)


def with_cells(rows: DataFrame, cells: Cells) -> DataFrame:
    """Add the packed approximation ``cells`` to the vectors."""
    shared = Shared(rows.sparkSession, cells)

    @F.pandas_udf("binary")
    def approximate(grids: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = shared.value
        for g in grids:
            packed = of.pack(of.number(np.stack(g.to_numpy()))) if len(g) else []
            yield pd.Series([bytes(x) for x in packed], dtype=object)

    return rows.select("vec_id", "grid", approximate("grid").alias("cells"))


def centroids_left(cells: Cells, centroids: np.ndarray):
    """A function: packed cells -> (vectors x centroids) boolean, False where a centroid
    cannot be the nearest."""
    near, far = cells.bounds(centroids)
    dims = np.arange(len(cells.borders))

    def left(packed: np.ndarray, step: int = 1024) -> np.ndarray:
        out = np.empty((len(packed), len(centroids)), dtype=bool)
        for i in range(0, len(packed), step):
            number = cells.unpack(packed[i:i + step])
            least = near[dims, number].sum(axis=1)
            out[i:i + step] = least <= far[dims, number].sum(axis=1).min(axis=1, keepdims=True)
        return out

    return left


def squared(grid: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of vectors to one centroid each."""
    gap = grid - centroids
    return (gap * gap).sum(axis=1)


def assign(rows: DataFrame, cells: Cells, centroids: np.ndarray) -> DataFrame:
    """Add ``cluster`` (the nearest centroid, ties: the smaller number) and ``in_full``
    (whether the vector itself was needed to tell)."""
    shared = Shared(rows.sparkSession, (cells, centroids))

    @F.pandas_udf("array<int>")
    def candidates(packed: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of, c = shared.value
        left = centroids_left(of, c)
        for p in packed:
            keep = left(np.frombuffer(b"".join(p), dtype=np.uint8).reshape(len(p), -1)) if len(p) else []
            yield pd.Series([np.flatnonzero(k).astype(np.int32) for k in keep], dtype=object)

    @F.pandas_udf("int")
    def nearest(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        _, c = shared.value
        for among, grid in parts:
            out = np.zeros(len(among), dtype=np.int32)
            sizes = among.map(len).to_numpy(dtype=np.int64)
            one, many = sizes == 1, sizes > 1
            out[one] = [a[0] for a in among[one]]
            if many.any():
                vectors = np.stack(grid[many].to_numpy())
                best = np.full(len(vectors), np.iinfo(np.int64).max)
                pick = np.zeros(len(vectors), dtype=np.int32)
                may = np.zeros((len(vectors), len(c)), dtype=bool)
                may[np.repeat(np.arange(len(vectors)), sizes[many]), np.concatenate(among[many].to_numpy())] = True
                for k in range(len(c)):
                    at = np.flatnonzero(may[:, k])
                    far = squared(vectors[at], c[k])
                    closer = far < best[at]
                    best[at[closer]], pick[at[closer]] = far[closer], k
                out[many] = pick
            yield pd.Series(out)

    rows = rows.withColumn("_among", candidates("cells"))
    in_full = F.size("_among") > 1
    # decided vectors go on without their components
    return (rows.withColumn("cluster", nearest("_among", F.when(in_full, F.col("grid"))))
            .withColumn("in_full", in_full).drop("_among"))


def next_centroids(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor(sum / count) of each cluster; empty clusters keep theirs."""
    dims = centroids.shape[1]
    sums = assigned.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.get("grid", F.lit(d))).alias(f"s{d}") for d in range(dims)])
    out = centroids.copy()
    for r in sums.collect():
        out[r.cluster] = [r[f"s{d}"] // r.n for d in range(dims)]
    return out


def distance_to(rows: DataFrame, centroids: np.ndarray) -> Column:
    shared = Shared(rows.sparkSession, centroids)

    @F.pandas_udf("long")
    def distance(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        c = shared.value
        for grid, cluster in parts:
            yield pd.Series(squared(np.stack(grid.to_numpy()), c[cluster.to_numpy()]) if len(grid) else [],
                            dtype=np.int64)

    return distance("grid", "cluster")


def cluster_vectors(table: DataFrame, dims: int = 64, scale: int = 64, count: int = 16, rounds: int = 3,
                    seed: int = 1, bits: int = BITS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 and in_full, one row
    per kept vector.

    Rows whose ``embedding`` is NULL, has another length or holds NULL, NaN or infinite
    components are not kept. Repeated rows count each. A NULL id stays NULL (its digest is
    that of an empty id). Fewer vectors than ``count`` make as many centroids as there
    are; none make an empty result. Components beyond 2^27 on the grid are set to 2^27. An
    inertia beyond 64 bits is NULL. Only vec_id and embedding are read, so other columns do
    not matter.
    """
    spark = table.sparkSession
    scratch = Scratch(spark, "va-clusters")
    vectors = scratch.write(kept_vectors(table, dims, scale), "grid")
    centroids = first_centroids(vectors, count, seed)
    vec_type = dict(table.dtypes)["vec_id"]
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {vec_type}, cluster int, distance long, cluster_inertia long, "
                                         "inertia long, centroid_sha256 string, in_full boolean")
    cells = make_cells(vectors, dims, bits)
    file = scratch.write(with_cells(vectors, cells), "cells")
    scratch.drop("grid")
    for _ in range(rounds):
        centroids = next_centroids(assign(file, cells, centroids), centroids)
    last = assign(file, cells, centroids)
    placed = scratch.write(last.select("vec_id", "cluster", distance_to(last, centroids).alias("distance"), "in_full"),
                           "placed")
    scratch.drop("cells")
    # one row per centroid
    sums = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 2 ** 63 else None
    facts = spark.createDataFrame(
        [(k, fits(s), fits(sum(sums.values())), centroid_digest(centroids[k])) for k, s in sorted(sums.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "in_full")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def _round_sql(k: int) -> str:
    return f"""
a{k} AS MATERIALIZED (
  SELECT vec_id, arg_min(c, (d, c)) AS cluster, min(d) AS distance FROM (
    SELECT vec_id, c, sum((v.x - m.x) * (v.x - m.x)) AS d FROM v JOIN c{k} m USING (i) GROUP BY vec_id, c)
  GROUP BY vec_id)""" + ("" if k == 3 else f""",
c{k + 1} AS MATERIALIZED (
  SELECT o.c, o.i, coalesce(n.x, o.x) AS x FROM c{k} o LEFT JOIN (
    SELECT cluster AS c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x
    FROM v JOIN a{k} USING (vec_id) GROUP BY cluster, i) n USING (c, i)),""")


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT vec_id, i, floor(64 * embedding[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, embedding, unnest(range(1, 65)) AS i FROM embeddings
        WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)),
c0 AS MATERIALIZED (
  SELECT c, i, x FROM v JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c
    FROM (SELECT DISTINCT vec_id FROM v) ORDER BY c LIMIT 16) USING (vec_id)),""" + "".join(
    _round_sql(k) for k in range(4)) + """
SELECT vec_id, cluster::INTEGER AS cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) FROM c3 WHERE c = cluster) AS centroid_sha256
FROM a3
"""
