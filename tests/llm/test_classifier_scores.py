"""The classifiers' scores against plain loops over texts, with random models in place of
fitted ones, and the toxic documents found in the given tables."""

import math
import os
import random
import zlib

import numpy as np
import pytest

from rewardflow.llm import quality_mil, quality_rules, toxicity

DOCS = "doc_id long, text string, score string"
LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.01"


def texts():
    rng = random.Random(12)
    words = ["a", "The", "the", "it's", "e-mail", "日本", "naïve", "x" * 90, "QQ7", "!!", "spam", "spam"]
    out = [" ".join(rng.choices(words, k=rng.randint(0, 200))) for _ in range(25)]
    return [*out, None, "", " \n ", "one", "same same " * 60, out[3], "w" * 3000, "plain words only " * 40]


def frames(spark):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts())], DOCS).repartition(3)
    return docs, spark.createDataFrame([], LABELS)


def logistic(x):
    return 1 / (1 + math.exp(-x))


def test_toxicity_scores(spark, monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.SubwordModel(rng.normal(0, 3, 512).astype(np.float32), -0.3)
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: model)
    got = {r.doc_id: r for r in toxicity.score_toxicity(*frames(spark)).collect()}
    for i, text in enumerate(texts()):
        raw = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        counts: dict = {}
        for w in bytes(c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in raw).split():
            counts[w] = counts.get(w, 0) + 1
        logit, total = 0.0, sum(n ** 0.5 for n in counts.values()) + 10
        for w, n in counts.items():
            marked = b"<" + w + b">"
            grams = [marked[k:k + size] for size in (3, 4, 5) for k in range(len(marked) - size + 1)]
            logit += n ** 0.5 / total * np.mean([float(model.gram[zlib.crc32(g) % 512]) for g in grams])
        assert got[i].score == pytest.approx(logistic(logit - 0.3), abs=1e-6)
        assert got[i].predicted == int(got[i].score >= 0.5)


def test_quality_scores(spark, monkeypatch):
    model = quality_mil.AttentionModel.start(seed=3)
    rng = np.random.default_rng(2)
    model.w["embed"] = rng.normal(0, 1, model.w["embed"].shape)
    monkeypatch.setattr(quality_mil, "fit", lambda *a, **k: model)
    got = {r.doc_id: r for r in quality_mil.score_quality(*frames(spark)).collect()}
    w = model.w
    for i, text in enumerate(texts()):
        words = (text or "").encode().split()
        parts = [words[k:k + 64] for k in range(0, len(words), 64)] or [[]]
        encoded, strength = [], []
        for part in parts:
            mean = np.zeros(quality_mil.WIDTH)
            for t in part:
                mean += np.mean([w["embed"][f] for f in quality_mil.token_features(t)], axis=0) / len(part)
            again = [sum(part[k] == part[k - lag] for k in range(lag, len(part))) / max(1, len(part)) for lag in (1, 2)]
            x = np.r_[mean, again, len(part) / 64, float(not part)]
            h = np.tanh(x @ w["enc"] + w["enc0"])
            gate = np.array([logistic(v) for v in h @ w["u"]])
            encoded.append(h)
            strength.append(math.exp((np.tanh(h @ w["v"]) * gate) @ w["att"]))
        z = sum(s * h for s, h in zip(strength, encoded)) / sum(strength)
        assert got[i].score == pytest.approx(logistic(z @ w["out"] + w["out0"][0]), abs=1e-5)
        assert got[i].predicted == int(got[i].score >= 0.3)


def test_rule_verdicts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    n = quality_rules.BUCKETS
    model = quality_rules.RuleModel(rng.normal(0, 2, n), -0.5, 1.3, 0.1)
    monkeypatch.setattr(quality_rules, "fit", lambda *a, **k: model)
    got = {r.doc_id: r for r in quality_rules.apply_rules(*frames(spark)).collect()}
    kept = 0
    for i, text in enumerate(texts()):
        words, logit = (text or "").encode().split(), -0.5
        for w in words:
            marked = b" " + w + b" "
            ids = [zlib.crc32(w)] + [zlib.crc32(marked[k:k + size], size) for size in (2, 3, 4)
                                     for k in range(len(marked) - size + 1)]
            logit += np.mean([model.weight[x % n] for x in ids]) / len(words)
        pairs = [model.weight[(zlib.crc32(a) * int(quality_rules._PAIR) ^ zlib.crc32(b)) % n] for a, b in zip(words, words[1:])]
        logit += np.mean(pairs) if pairs else 0
        r = got[i]
        assert r.probability == pytest.approx(logistic(1.3 * logit + 0.1), abs=1e-9)
        assert r.kept == (not r.base_failed and r.probability >= 0.3)
        kept += r.kept
    assert 0 < kept < len(got)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_toxic_documents_are_found(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").where(
        "toxic is not null").collect()
    bad, good = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    # a constant has an area of one half under its curve and finds all or none
    area = np.mean([(b > g) + (b == g) / 2 for b in bad for g in good])
    found, flagged = np.mean([s >= 0.5 for s in bad]), np.mean([s >= 0.5 for s in good])
    assert area >= 0.85 and found >= 0.5 and flagged <= 0.1, (area, found, flagged)
