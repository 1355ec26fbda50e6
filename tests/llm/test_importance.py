import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from rewardflow.llm.importance import bucket_counts, feature_hashes, kth_key, resample

DOCS = "doc_id long, text string, score string, rank int"


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return w, w + [" ".join(p) for p in zip(w, w[1:])]


def brute(rows, target, percent, min_words, seed):
    """(doc_id, n_features, weight, score, rank) by plain sorting."""
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % 10000 for t in texts for f in features(t)[1])
    s, t = counts(x for _, x in rows), counts(target)
    ts, tt = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (ts + 10000) / ((s[b] + 1) * (tt + 10000)))) for b in range(10000)]
    made = []
    for i, text in rows:
        words, feats = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10000] for f in feats) // len(feats) if feats else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        made.append([i, len(feats), weight, score, None, len(words) >= min_words])
    able = sorted((m for m in made if m[5]), key=lambda m: (-m[3], m[0] is None, m[0] or 0, m[1]))
    for k, m in enumerate(able[:percent * len(able) // 100]):
        m[4] = k + 1
    return Counter(tuple(m[:5]) for m in made)


def test_resample_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = ["alpha", "Beta", "γάμμα", "d1", "x" * 70, "été", "漢字"]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(0, 12)))) for i in range(120)]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, "alpha beta alpha d1"), (None, None), (900, None), (901, ""),
             (902, "?!\n"), (7, "another text with the id of seven in it"), (903, " ".join(vocab * 4000))]
    target = ["alpha d1 alpha", None, "", "γάμμα γάμμα"]
    docs = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], DOCS).repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    for percent, least in ((25, 3), (100, 0)):
        got = resample(docs, bench, percent, least, seed=7).collect()
        assert Counter(tuple(r)[:5] for r in got) == brute(rows, target, percent, least, 7)


def test_no_rows_and_no_target(spark):
    none = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "text string")
    assert resample(none, bench).count() == 0
    one = spark.createDataFrame([(1, "a b c", None, None)], DOCS)
    assert [tuple(r)[:5] for r in resample(one, bench, 100, 1).collect()] == [
        k for k in brute([(1, "a b c")], [], 100, 1, 7)]


def test_long_texts_by_pieces():
    text = " ".join(f"w{i % 97} Ünder" for i in range(3000)).encode() + b"z" * 5000
    for run in (1, 2, 3):
        whole = [h for _, x in feature_hashes(text, run) for h in x.tolist()]
        cut = [h for _, x in feature_hashes(text, run, size=50) for h in x.tolist()]
        words = text.lower().split()
        want = Counter(zlib.crc32(b" ".join(words[i:i + k])) for k in range(1, run + 1)
                       for i in range(len(words) - k + 1))
        assert Counter(whole) == Counter(cut) == want
        assert sum(n for n, _ in feature_hashes(text, run, size=50)) == len(words)


def test_kth_key_with_ties(spark):
    rng = random.Random(1)
    values = [(rng.randint(0, 9), rng.randint(0, 30)) for _ in range(700)] + [(4, 4)] * 300
    rows = spark.createDataFrame(values, "a long, b long").repartition(7).persist()
    key = F.struct("a", "b")
    ordered = sorted(values)
    for k in (1, 350, 1000):
        assert kth_key(rows, key, k, pivots=4) == ordered[k - 1]
    assert kth_key(rows, key, 1001) is None
    rows.unpersist()


def test_counts_follow_all_rows(spark):
    rows = spark.createDataFrame([("a b",), ("a",), (None,)], "text string")
    n = bucket_counts(rows, buckets=50)
    assert n.sum() == 4 and n[zlib.crc32(b"a") % 50] >= 2
