"""Bounded labelled samples for the classifiers, and the optimiser they share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import id_crc, text_bytes

HOLDOUT = 5
#: labelled rows per class, and bytes of a text, that a classifier is fitted on at most
ROWS_PER_CLASS, TEXT_BYTES = 1500, 1 << 16


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = ROWS_PER_CLASS,
                    text_limit: int = TEXT_BYTES, holdout: int | None = HOLDOUT,
                    ) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """At most ``rows`` labelled texts per class: (texts, labels 0/1, weights, folds).

    A weight is how many labelled rows of its class a sampled row stands for; a
    fold is the id's crc32 mod 100.

    The rows are those with the smallest hash of their id, so a rerun takes the
    same ones. Rows whose id has crc32 mod ``holdout`` 0, NULL ids, NULL labels
    and texts over ``text_limit`` bytes are left out; an id with several labels
    counts with the largest, one with several texts with the smallest.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(
        "doc_id is not null and y in (0, 1)")
    if holdout:
        known = known.where(id_crc(holdout) != 0)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("y = 0").orderBy(*by_hash).limit(rows).unionByName(
        known.where("y = 1").orderBy(*by_hash).limit(rows))
    texts = docs.select("doc_id", text_bytes().alias("t")).where(F.length("t") <= text_limit)
    got = (texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id")
           .agg(F.min("t").alias("t"), F.first("y").alias("y"))
           .select("doc_id", "t", "y", id_crc(100).alias("fold")).collect())
    got.sort(key=lambda r: r.doc_id)
    y = np.array([r.y for r in got], dtype=np.float64)
    totals = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    share = {k: n / max(1, int((y == k).sum())) for k, n in totals.items()}
    return ([bytes(r.t) for r in got], y, np.array([share[k] for k in y]),
            np.array([r.fold for r in got], dtype=np.int64))


class Adam:
    """Adam steps on a dict of arrays, in place."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(w) for k, w in weights.items()}
        self.v = {k: np.zeros_like(w) for k, w in weights.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            self.weights[k] -= self.rate * (m / (1 - 0.9 ** self.t)) / (
                np.sqrt(v / (1 - 0.999 ** self.t)) + 1e-8)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def scatter(index: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``rows`` by index, n rows."""
    return np.stack([np.bincount(index, weights=rows[:, k], minlength=n)
                     for k in range(rows.shape[1])], axis=1)


def segment_sum(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of ``rows`` of the given sizes (0 allowed)."""
    total = np.concatenate([np.zeros((1, *rows.shape[1:])), np.cumsum(rows, axis=0, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]
