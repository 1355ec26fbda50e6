"""Quality rules: counted rules and a hashed n-gram logistic regression.

The rules count what is easy to say (too few words, too many repeated ones);
the regression learns the rest from labelled rows: hashed words, word pairs and
character n-grams, averaged over the text's words, trained in numpy on a bounded
sample, and calibrated by Platt scaling on rows kept out of the fit. Texts are
scored in Arrow batches against a fixed probability threshold. A word's share
(itself and its character n-grams) is one number, computed once a task and word;
n-grams are taken of the whole word, of long words (no spaces in the script,
encoded data) slice by slice.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Shared, text_bytes
from rewardflow.llm.training import (
    Adam, TEXT_BYTES, labelled_sample, segment_sum, sigmoid)

BUCKETS = 1 << 18
GRAMS = (2, 3, 4)
ROWS, EPOCHS, RATE, DECAY = 1000, 60, 0.5, 1e-6
#: folds (of 100) kept for calibration, and the probability a kept text has at least
CALIBRATION_FOLDS, THRESHOLD = 20, 0.3
LEAST_WORDS, MOST_REPEATED = 50, 50
CACHE_WORDS = 500_000
#: words over so many bytes are hashed by array, so many bytes at a time
LONG, SLICE = 64, 1 << 16
SYMBOLS = b"#*$%&|<>"
_PAIR = np.int64(0x9E3779B1)
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    again = Counter(windows) if len(set(windows)) < len(windows) else {}
    repeated, upto = 0, 0
    if again:
        for i, w in enumerate(windows):
            if again[w] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    return chars, symbols, len(lines) - len(set(lines)), repeated


def word_features(word: bytes) -> list[int]:
    """Buckets of the word and of its character n-grams."""
    if len(word) > LONG:
        return np.concatenate(list(long_features(word))).tolist()
    marked, crc = b" " + word + b" ", zlib.crc32
    n = len(marked)
    return [crc(word) % BUCKETS] + [crc(marked[i:i + k], k) % BUCKETS
                                    for k in GRAMS for i in range(n - k + 1)]


def long_features(word: bytes) -> Iterator[np.ndarray]:
    """What ``word_features`` has, in bounded arrays."""
    yield np.array([zlib.crc32(word) % BUCKETS])
    marked = np.frombuffer(b" " + word + b" ", dtype=np.uint8)
    for k in GRAMS:
        n = len(marked) - k + 1
        for at in range(0, n, SLICE):
            size = min(SLICE, n - at)
            crc = np.full(size, 0xFFFFFFFF ^ k, dtype=np.uint32)
            for j in range(k):
                crc = _CRC[(crc ^ marked[at + j:at + j + size]) & 0xFF] ^ (crc >> 8)
            yield (~crc % BUCKETS).astype(np.int64)


def pair_features(words: list[bytes]) -> np.ndarray:
    """Bucket of each pair of neighbouring words."""
    ids = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    return ((ids[:-1] * _PAIR) ^ ids[1:]) % BUCKETS


def text_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values): means over the words and over the pairs."""
    counts = Counter(words)
    at, value = [], []
    for w, n in counts.items():
        f = word_features(w)
        at += f
        value += [n / len(words) / len(f)] * len(f)
    pairs = pair_features(words)
    at = np.concatenate([np.array(at, dtype=np.int64), pairs])
    value = np.concatenate([np.array(value), np.full(len(pairs), 1.0 / max(1, len(pairs)))])
    used, back = np.unique(at, return_inverse=True)
    return used, np.bincount(back, weights=value, minlength=len(used))


@dataclass
class RuleModel:
    """``weight`` by bucket and ``bias`` of the regression; ``slope`` and ``shift``
    of the calibration."""

    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, words: list[bytes], cache: dict[bytes, float]) -> float:
        if not words:
            return self.bias
        new = set(words).difference(cache)
        for w in [w for w in new if len(w) > LONG]:
            new.discard(w)
            parts = [(float(self.weight[x].sum()), len(x)) for x in long_features(w)]
            cache[w] = sum(s for s, _ in parts) / sum(n for _, n in parts)
        if new:
            new = sorted(new)
            ids = [word_features(w) for w in new]
            sizes = np.array([len(x) for x in ids])
            cache.update(zip(new, (segment_sum(self.weight[np.concatenate(ids)], sizes) / sizes).tolist()))
        out = self.bias + sum(map(cache.__getitem__, words)) / len(words)
        if len(words) > 1:
            out += float(self.weight[pair_features(words)].mean())
        return out

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * logits + self.shift)


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray, folds: np.ndarray) -> RuleModel:
    """Regression on the rows outside the calibration folds, Platt scaling on those
    within. Without labels of both classes the model is the constant class (label 1
    without any label); without both in the calibration rows it stays unscaled."""
    if not len(y) or y.min() == y.max():
        return RuleModel(np.zeros(BUCKETS), 6.0 * (2 * y.mean() - 1) if len(y) else 6.0)
    rows = [text_features(t.split()) for t in texts]
    held = folds < CALIBRATION_FOLDS
    if len(set(y[~held])) < 2:
        held[:] = False
    learn = np.flatnonzero(~held)
    sizes = np.array([len(rows[i][0]) for i in learn])
    flat = np.concatenate([rows[i][0] for i in learn])
    value = np.concatenate([rows[i][1] for i in learn])
    used, at = np.unique(flat, return_inverse=True)
    doc = np.repeat(np.arange(len(learn)), sizes)
    model = {"w": np.zeros(len(used)), "b": np.zeros(1)}
    adam = Adam(model, RATE)
    # both classes weigh alike in the fit; calibration restores their true shares
    of = y[learn]
    share = np.where(of == 1, 0.5 / of.sum(), 0.5 / (1 - of).sum())
    for _ in range(EPOCHS):
        logits = np.bincount(doc, weights=model["w"][at] * value, minlength=len(learn)) + model["b"][0]
        g = (sigmoid(logits) - y[learn]) * share
        adam.step({"w": np.bincount(at, weights=g[doc] * value, minlength=len(used)) + DECAY * model["w"],
                   "b": g.sum(keepdims=True)})
    full = np.zeros(BUCKETS)
    full[used] = model["w"]
    out = RuleModel(full, float(model["b"][0]))
    calibrate = np.flatnonzero(held)
    if len(set(y[calibrate])) == 2:
        z = np.array([rows[i][1] @ full[rows[i][0]] + out.bias for i in calibrate])
        out.slope, out.shift = platt(z, y[calibrate], weight[calibrate])
    return out


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and shift of the probability by Newton steps, with Platt's smoothed targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1e-9, float(np.abs(z).max()))
    x = np.c_[z / scale, np.ones(len(z))]
    weight = weight / weight.sum()
    ab = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ ab)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        ab = ab - np.linalg.solve(hess, x.T @ (weight * (p - target)) + 1e-6 * ab)
    return float(ab[0] / scale), float(ab[1])


def apply_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
                rows_per_class: int = ROWS, text_limit: int = TEXT_BYTES) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and the calibrated probability, one row per row.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated
    3-word windows. ``kept``: not failed, and a probability of ``threshold`` or
    more. NULL and empty texts have no words and fail. An empty table gives an
    empty result; other columns are ignored.
    """
    texts, y, weight, folds = labelled_sample(docs, labels, "quality", rows_per_class, text_limit, None)
    shared = Shared(docs.sparkSession, fit(texts, y, weight, folds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, {}
        for batch in batches:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            counts, logits = [], []
            for text in batch.column("_text"):
                text = text.as_py()
                words = text.split()
                counts.append((len(words), *base_counts(text, words)))
                logits.append(model.logit(words, cache))
            columns = np.array(counts, dtype=np.int64).reshape(-1, 5)
            failed = (columns[:, 0] < LEAST_WORDS) | (100 * columns[:, 4] > MOST_REPEATED * columns[:, 0])
            p = model.probability(np.array(logits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(columns[:, k]) for k in range(5)],
                 pa.array(failed), pa.array(~failed & (p >= threshold)), pa.array(p, pa.float64())],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_repeat_words", "base_failed", "kept", "probability"])

    src = docs.select("doc_id", text_bytes().alias("_text"))
    return src.mapInArrow(run, f"doc_id {dict(src.dtypes)['doc_id']}, n_words long, word_chars long, "
                               "n_symbols long, n_dup_lines long, n_repeat_words long, "
                               "base_failed boolean, kept boolean, probability double")
