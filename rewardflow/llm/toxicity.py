"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the hashed vectors of its character n-grams; a
text's vector is the mean of its words' vectors; a linear softmax over the text
vector gives the two class probabilities. Embeddings and softmax are trained
jointly in numpy on a bounded labelled sample. An unseen misspelling shares
n-grams, and so vectors, with the words it resembles. The averages are linear,
so at scoring time a word is one number, computed once a task and word.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardflow.llm.common import Shared, id_crc, text_bytes
from rewardflow.llm.training import (
    Adam, HOLDOUT, TEXT_BYTES, labelled_sample, scatter, segment_sum, sigmoid)

BUCKETS, WIDTH, EPOCHS, RATE = 1 << 18, 4, 60, 0.1
ROWS = 1000
#: standard errors at which an n-gram's log odds are shrunk to an eighth, the pull of
#: the vectors to their start, and the softmax's first steepness
CAUTION, PULL, GAIN = 2.5, 0.01, 1000.0
GRAMS = (3, 4, 5)
#: power of a word's count, and words of vector 0 that every text has besides
DAMP, NEUTRAL = 0.5, 10
CACHE_WORDS = 500_000
_SPACED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and non-ASCII bytes, A-Z in lower case."""
    return text.lower().translate(_SPACED).split()


def subwords(word: bytes, buckets: int = BUCKETS) -> list[int]:
    marked, crc = b"<" + word + b">", zlib.crc32
    n = len(marked)
    return [crc(marked[i:i + k]) % buckets for k in GRAMS for i in range(n - k + 1)] or [
        crc(marked) % buckets]


def bag_weights(counts: Counter) -> list[float]:
    """Each word's weight in its text's average: damped counts over their sum and
    ``NEUTRAL`` words of vector 0, so one chance word does not decide a short text."""
    damped = [n ** DAMP for n in counts.values()]
    total = sum(damped) + NEUTRAL
    return [x / total for x in damped]


@dataclass
class SubwordModel:
    """``gram``: each n-gram bucket's share in the logit of label 1 (its vector times
    the difference of the softmax rows); ``bias``: what a text without words has."""

    gram: np.ndarray
    bias: float

    def score(self, texts: list[bytes], cache: dict[bytes, float] | None = None) -> np.ndarray:
        cache = {} if cache is None else cache
        if len(cache) > CACHE_WORDS:
            cache.clear()
        gram, out = self.gram, np.empty(len(texts))
        for i, text in enumerate(texts):
            words = Counter(words_of(text))
            new = set(words).difference(cache)
            if new:
                new = sorted(new)
                ids = [subwords(w, len(gram)) for w in new]
                sizes = np.array([len(x) for x in ids])
                sums = segment_sum(gram[np.concatenate(ids)], sizes)
                cache.update(zip(new, (sums / sizes).tolist()))
            out[i] = self.bias + sum(map(mul, map(cache.__getitem__, words), bag_weights(words)))
        return sigmoid(out)


class Bags:
    """The sample's distinct words with their n-gram buckets, and each text's words
    with their weights."""

    def __init__(self, texts: list[bytes], buckets: int):
        vocabulary: dict[bytes, int] = {}
        word, weight, size = [], [], []
        for text in texts:
            counts = Counter(words_of(text))
            word.append(np.array([vocabulary.setdefault(w, len(vocabulary)) for w in counts], dtype=np.int32))
            weight.append(np.array(bag_weights(counts), dtype=np.float32))
            size.append(len(counts))
        self.word, self.weight = np.concatenate(word), np.concatenate(weight)
        self.size = np.array(size)
        grams = [np.array(subwords(w, buckets), dtype=np.int32) for w in vocabulary]
        self.grams_of = np.array([len(g) for g in grams] or [1])
        self.gram = np.concatenate(grams or [np.zeros(1, np.int32)])
        self.first = np.cumsum(self.grams_of) - self.grams_of

    def evidence(self, y: np.ndarray, n: int) -> np.ndarray:
        """Log odds of each n-gram by the texts that hold it, shrunk the more the fewer
        standard errors they are: what chance alone explains starts near 0."""
        held = np.ones((2, n))
        ends = np.cumsum(self.size)
        for end, size, of in zip(ends, self.size, y.astype(int)):
            words = self.word[end - size:end]
            sizes = self.grams_of[words]
            at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            held[of, np.unique(self.gram[np.repeat(self.first[words], sizes) + at])] += 1
        odds = np.log(held[1] / (y.sum() + 2)) - np.log(held[0] / ((1 - y).sum() + 2))
        return odds * (odds ** 2 / (odds ** 2 + CAUTION ** 2 * (1 / held).sum(axis=0))) ** 3


def fit(texts: list[bytes], y: np.ndarray, buckets: int = BUCKETS, width: int = WIDTH,
        epochs: int = EPOCHS, rate: float = RATE) -> SubwordModel:
    """Joint training of embeddings and softmax by full-batch Adam steps.

    The first embedding coordinate starts at the n-gram's evidence and the others
    at noise, so a small sample does not have to find the few telling n-grams
    among many chance ones. The vectors of all n-grams are trained, rare ones too;
    a quadratic penalty holds them to their start. Without texts of both classes the model is constant.
    """
    if not len(y) or y.min() == y.max():
        return SubwordModel(np.zeros(buckets, np.float32),
                            float(6.0 * (2 * y.mean() - 1)) if len(y) else -6.0)
    bags = Bags(texts, buckets)
    word, weight, sizes = bags.word, bags.weight, bags.grams_of
    doc = np.repeat(np.arange(len(texts)), bags.size)
    evidence = bags.evidence(y, buckets)
    of_word = np.repeat(np.arange(len(sizes)), sizes)
    used, gram = np.unique(bags.gram, return_inverse=True)
    rng = np.random.default_rng(17)
    grams = np.c_[evidence[used], rng.normal(0, 0.01, (len(used), width - 1))]
    first = grams.copy()
    model = {"grams": grams, "softmax": np.zeros((width, 2)), "bias": np.zeros(2)}
    model["softmax"][0] = (-GAIN / 2, GAIN / 2)
    adam = Adam(model, rate)
    target = np.stack([1 - y, y], axis=1)
    balance = np.where(y == 1, 0.5 / y.sum(), 0.5 / (1 - y).sum())[:, None]
    for _ in range(epochs):
        of_words = scatter(of_word, model["grams"][gram], len(sizes)) / sizes[:, None]
        text = scatter(doc, of_words[word] * weight[:, None], len(texts))
        logits = text @ model["softmax"] + model["bias"]
        p = sigmoid(logits[:, 1] - logits[:, 0])
        g = (np.stack([1 - p, p], axis=1) - target) * balance
        g_text = g @ model["softmax"].T
        g_words = scatter(word, g_text[doc] * weight[:, None], len(sizes)) / sizes[:, None]
        adam.step({"softmax": text.T @ g, "bias": g.sum(axis=0),
                   "grams": scatter(gram, g_words[of_word], len(used)) + PULL * (model["grams"] - first)})
    lean = model["softmax"][:, 1] - model["softmax"][:, 0]
    out = np.zeros(buckets, np.float32)
    out[used] = model["grams"] @ lean
    return SubwordModel(out, float(model["bias"][1] - model["bias"][0]))


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                   rows_per_class: int = ROWS, text_limit: int = TEXT_BYTES) -> DataFrame:
    """doc_id, held_out, score (probability of label 1) and predicted, one row per row.

    Learns from the labelled sample only (see ``labelled_sample``); a score depends
    on the text alone. NULL and empty texts get the score of a text without words.
    Without labels of both classes every score is the constant class. Broadcast:
    one float per n-gram bucket.
    """
    texts, y, _, _ = labelled_sample(docs, labels, "toxic", rows_per_class, text_limit)
    shared = Shared(docs.sparkSession, fit(texts, y))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, cache = shared.value, {}
        for f in frames:
            score = model.score(list(f.pop("_text")), cache)
            yield f.assign(score=score, predicted=(score >= threshold).astype(np.int32))

    src = docs.select("doc_id", (id_crc(HOLDOUT) == 0).alias("held_out"), text_bytes().alias("_text"))
    return src.mapInPandas(run, f"doc_id {dict(src.dtypes)['doc_id']}, held_out boolean, "
                                "score double, predicted int")
