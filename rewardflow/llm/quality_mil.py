"""Quality by attention-based multiple-instance learning.

A text is a bag of passages of ``PASSAGE`` words. A passage is encoded from the
mean of its tokens' hashed feature vectors (shape, first and last characters)
and the shares of tokens that repeat one of the two before; gated attention
gives every passage a weight, and a logistic layer scores the weighted sum of
the encodings. All of it is learned in numpy from document labels on a bounded
labelled sample. Every passage of every text is scored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Shared, id_crc, text_bytes
from rewardflow.llm.training import (
    Adam, HOLDOUT, TEXT_BYTES, labelled_sample, scatter, segment_sum, sigmoid)

PASSAGE = 64
BUCKETS, WIDTH, HIDDEN, ATTEND = 1 << 14, 8, 12, 8
ROWS, EPOCHS, RATE, DECAY = 1000, 60, 0.03, 1e-5
CACHE_TOKENS = 150_000
_SHAPE = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 else 48 if 48 <= c <= 57
               else 200 if c >= 128 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


def token_features(token: bytes) -> tuple[int, int, int]:
    shape = _RUN.sub(rb"\1", token.translate(_SHAPE))
    crc = zlib.crc32
    return (crc(b"s" + shape) % BUCKETS, crc(b"<" + token[:3]) % BUCKETS,
            crc(b">" + token[-3:]) % BUCKETS)


class Passages:
    """Texts cut into passages: token rows, passage sizes and repeat shares. A text
    without words is one empty passage."""

    def __init__(self, texts: list[bytes], rows: dict[bytes, int]):
        words = [t.split() for t in texts]
        n = np.array([len(w) for w in words], dtype=np.int64)
        self.new = []
        for w in words:
            for t in set(w).difference(rows):
                rows[t] = len(rows)
                self.new.append(t)
        self.token = np.fromiter((r for w in words for r in map(rows.__getitem__, w)),
                                 dtype=np.int64, count=int(n.sum()))
        self.per_text = np.maximum(1, -(-n // PASSAGE))
        first = np.cumsum(self.per_text) - self.per_text
        size = np.full(int(self.per_text.sum()), PASSAGE, dtype=np.int64)
        size[first + self.per_text - 1] = n - (self.per_text - 1) * PASSAGE
        self.size = size
        start = np.cumsum(size) - size
        at = np.arange(len(self.token)) - np.repeat(start, size)
        again = [np.zeros(len(self.token)), np.zeros(len(self.token))]
        for lag in (1, 2):
            if len(self.token) > lag:
                again[lag - 1][lag:] = (self.token[lag:] == self.token[:-lag]) & (at[lag:] >= lag)
        some = np.maximum(size, 1)[:, None]
        self.stats = np.c_[segment_sum(np.stack(again, axis=1), size) / some,
                           np.minimum(size, PASSAGE)[:, None] / PASSAGE, size[:, None] == 0]


class AttentionModel:
    """Weights by name; see ``forward``."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    @classmethod
    def start(cls, seed: int = 5) -> AttentionModel:
        rng = np.random.default_rng(seed)
        f = WIDTH + 4
        return cls({"embed": rng.normal(0, 0.1, (BUCKETS, WIDTH)),
                    "enc": rng.normal(0, f ** -0.5, (f, HIDDEN)), "enc0": np.zeros(HIDDEN),
                    "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTEND)),
                    "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, ATTEND)),
                    "att": rng.normal(0, ATTEND ** -0.5, ATTEND),
                    "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "out0": np.zeros(1)})

    def forward(self, p: Passages, mean: np.ndarray) -> dict[str, np.ndarray]:
        """``mean``: each passage's mean token vector."""
        w = self.w
        x = np.c_[mean, p.stats]
        h = np.tanh(x @ w["enc"] + w["enc0"])
        tv, su = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
        e = (tv * su) @ w["att"]
        bag = np.repeat(np.arange(len(p.per_text)), p.per_text)
        top = np.full(len(p.per_text), -np.inf)
        np.maximum.at(top, bag, e)
        a = np.exp(e - top[bag])
        a /= segment_sum(a[:, None], p.per_text)[bag, 0]
        z = segment_sum(a[:, None] * h, p.per_text)
        return {"x": x, "h": h, "tv": tv, "su": su, "a": a, "bag": bag, "z": z,
                "p": sigmoid(z @ w["out"] + w["out0"][0])}

    def gradients(self, p: Passages, s: dict[str, np.ndarray], y: np.ndarray, weight: np.ndarray,
                  ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the weighted log loss: by weight, and by passage mean vector."""
        w, bag, a, h, tv, su = self.w, s["bag"], s["a"], s["h"], s["tv"], s["su"]
        g = (s["p"] - y) * weight
        gz = g[:, None] * w["out"]
        ga = (gz[bag] * h).sum(axis=1)
        ge = a * (ga - segment_sum((a * ga)[:, None], p.per_text)[bag, 0])
        gt, gs = ge[:, None] * w["att"] * su, ge[:, None] * w["att"] * tv
        gv, gu = gt * (1 - tv ** 2), gs * su * (1 - su)
        gh = a[:, None] * gz[bag] + gv @ w["v"].T + gu @ w["u"].T
        gx = gh * (1 - h ** 2)
        return {"out": s["z"].T @ g, "out0": g.sum(keepdims=True), "att": (tv * su).T @ ge,
                "v": h.T @ gv, "u": h.T @ gu, "enc": s["x"].T @ gx, "enc0": gx.sum(axis=0)
                }, gx @ w["enc"].T[:, :WIDTH]


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS,
        rate: float = RATE) -> AttentionModel:
    """Full-batch Adam steps on the weighted log loss. Without labels of both
    classes the model is the constant class (label 1 without any label)."""
    model = AttentionModel.start()
    if not len(y) or y.min() == y.max():
        for k in ("out", "embed"):
            model.w[k][:] = 0
        model.w["out0"][:] = 6.0 * (2 * y.mean() - 1) if len(y) else 6.0
        return model
    rows: dict[bytes, int] = {}
    p = Passages(texts, rows)
    features = np.array([token_features(t) for t in p.new], dtype=np.int64).reshape(-1, 3)
    used, local = np.unique(features, return_inverse=True)
    local = local.reshape(-1, 3)
    passage = np.repeat(np.arange(len(p.size)), p.size)
    some = np.maximum(p.size, 1)[:, None]
    n = len(rows)
    weight = weight / weight.sum()
    embed = model.w.pop("embed")
    model.w["used"] = embed[used]
    adam = Adam(model.w, rate)
    # (passage, token) pairs counted once
    pair, count = np.unique(passage * max(n, 1) + p.token, return_counts=True)
    of_passage, of_token = pair // max(n, 1), pair % max(n, 1)
    for _ in range(epochs):
        vec = model.w["used"][local].mean(axis=1)
        mean = scatter(of_passage, vec[of_token] * count[:, None], len(p.size)) / some
        s = model.forward(p, mean)
        grads, g_mean = model.gradients(p, s, y, weight)
        g_vec = scatter(of_token, (g_mean / some)[of_passage] * count[:, None], n) / 3
        grads["used"] = sum(scatter(local[:, k], g_vec, len(used)) for k in range(3))
        for k in grads:
            grads[k] = grads[k] + DECAY * model.w[k]
        adam.step(grads)
    embed[:] = 0
    embed[used] = model.w.pop("used")
    model.w["embed"] = embed
    return model


class Scorer:
    """Scores texts with token vectors kept between batches."""

    def __init__(self, model: AttentionModel):
        self.model = model
        self.rows: dict[bytes, int] = {}
        self.vec = np.zeros((1 << 16, WIDTH), dtype=np.float32)

    def score(self, texts: list[bytes]) -> np.ndarray:
        if len(self.rows) > CACHE_TOKENS:
            self.rows.clear()
        p = Passages(texts, self.rows)
        if p.new:
            while len(self.rows) > len(self.vec):
                self.vec = np.concatenate([self.vec, np.zeros_like(self.vec)])
            ids = np.array([token_features(t) for t in p.new], dtype=np.int64)
            self.vec[len(self.rows) - len(p.new):len(self.rows)] = self.model.w["embed"][ids].mean(axis=1)
        sums = np.zeros((len(p.size), WIDTH))
        full = np.flatnonzero(p.size)
        if len(full):
            sums[full] = np.add.reduceat(self.vec[p.token], (np.cumsum(p.size) - p.size)[full], axis=0)
        return self.model.forward(p, sums / np.maximum(p.size, 1)[:, None])["p"]


def by_bytes(texts: list[bytes], enough: int = 1 << 19) -> Iterator[list[bytes]]:
    """The texts in runs of about ``enough`` bytes."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= enough:
            yield held
            held, n = [], 0
    if held:
        yield held


def score_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                  threshold: float = 0.3, rows_per_class: int = ROWS,
                  text_limit: int = TEXT_BYTES) -> DataFrame:
    """``keep`` columns plus held_out, score (probability of label 1) and predicted.

    Learns from the labelled sample only (see ``labelled_sample``), weighted to the
    labels' own class shares; a score depends on the text alone. NULL and empty
    texts are one empty passage. Without labels of both classes every score is the
    constant class. One row per row; an empty table gives an empty result.
    """
    texts, y, weight, _ = labelled_sample(docs, labels, "quality", rows_per_class, text_limit)
    shared = Shared(docs.sparkSession, fit(texts, y, weight))

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for part in parts:
            scores = [scorer.score(run) for run in by_bytes(list(part))]
            yield pd.Series(np.concatenate(scores) if scores else np.zeros(0))

    # not to be evaluated again by a filter on it
    scored = docs.select(*keep, (id_crc(HOLDOUT) == 0).alias("held_out"),
                         score.asNondeterministic()(text_bytes()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
