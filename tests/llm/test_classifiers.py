import os
import random
import zlib

import numpy as np
import pytest

from rewardflow.llm import quality_mil, quality_rules, toxicity
from rewardflow.llm.training import labelled_sample

DOCS = "doc_id long, text string, score string, _text long, kept string, held_out string"
LABELS = "doc_id long, quality int, toxic int, text string"
SF = "/root/testdata/sf0.01"


def made(spark, n=240):
    rng = random.Random(3)
    syllable = ["an", "the", "er", "on", "st", "ha", "re", "in"]
    word = lambda: "".join(rng.choices(syllable, k=rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(60, 300))]
        toxic, junk = rng.random() < 0.3, rng.random() < 0.3
        if toxic:
            for k in range(0, len(words), 25):
                words[k] = "krul" + word()
        text = " ".join(words)
        if junk:
            text = text.upper().replace(" ", "!! ")
        docs.append((i, text))
        labels.append((i, int(not junk), int(toxic), None))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(i, t, "s", 1, "k", "h") for i, t in docs], DOCS),
            spark.createDataFrame(labels, LABELS))


ODD = [(None, None), (None, "plain words here"), (900, ""), (901, "w " * 60000), (902, "\x00é日"), (902, "\x00é日")]


@pytest.mark.parametrize("score,label,column,cut", [
    (toxicity.score_toxicity, "toxic", 2, 0.5), (quality_mil.score_quality, "quality", 1, 0.3)])
def test_scores_held_out_rows(spark, score, label, column, cut):
    docs, labels = made(spark)
    d, ls = frames(spark, docs + ODD, labels + [(None, 1, 1, None), (5, None, None, None), (6, 7, 7, None)])
    out = score(d, ls).collect()
    assert len(out) == len(docs) + len(ODD)
    truth = {r[0]: r[column] for r in labels}
    for r in out:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 30
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    again = score(d.repartition(5), ls).collect()
    key = lambda rows: sorted((str(r.doc_id), round(r.score, 9)) for r in rows)
    assert key(out) == key(again)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = made(spark, 120)
    d, ls = frames(spark, docs, labels)
    flipped = [(i, 1 - q, 1 - t, x) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t, x) for i, q, t, x in labels]
    _, lf = frames(spark, docs, flipped)
    for score in (toxicity.score_toxicity, quality_mil.score_quality):
        a = {r.doc_id: r.score for r in score(d, ls).collect()}
        b = {r.doc_id: r.score for r in score(d, lf).collect()}
        assert a == pytest.approx(b, abs=1e-12)


def test_unseen_misspellings_share_subwords():
    rng = random.Random(1)
    clean = [" ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(80)) for _ in range(80)]
    bad = [t.replace(" ", " zorblax ", 4) for t in clean[:40]]
    model = toxicity.fit([t.encode() for t in clean + bad], np.array([0.0] * 80 + [1.0] * 40))
    probe = "abcde bcdef cdefg abcfg " * 5
    scores = model.score([(probe + w).encode() for w in ("gfedc", "zorblaxx", "zorrblax")])
    assert scores[1] > scores[0] and scores[2] > scores[0]


def test_rare_toxic_words_count():
    rng = random.Random(9)
    made = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(40))
    clean, bad = [made() for _ in range(150)], [made() + " zorblax" * 3 for _ in range(150)]
    bad[:5] = [made() + " qyzzwv" * 3 for _ in range(5)]
    model = toxicity.fit([t.encode() for t in clean + bad], np.array([0.0] * 150 + [1.0] * 150))
    texts = [made() for _ in range(20)]
    rare = model.score([f"{x} qyzzwv qyzzwv qyzzwv".encode() for x in texts])
    unseen = model.score([f"{x} jjkkjj jjkkjj jjkkjj".encode() for x in texts])
    assert (np.log(rare / (1 - rare)) > np.log(unseen / (1 - unseen)) + 1).all()


def test_one_class_no_labels_and_empty_tables(spark):
    docs, labels = made(spark, 12)
    d, ls = frames(spark, docs, [(i, 1, 0, None) for i, *_ in labels])
    assert {r.predicted for r in toxicity.score_toxicity(d, ls).collect()} == {0}
    assert {r.predicted for r in quality_mil.score_quality(d, ls).collect()} == {1}
    none = spark.createDataFrame([], LABELS)
    assert {r.predicted for r in toxicity.score_toxicity(d, none).collect()} == {0}
    assert {r.predicted for r in quality_mil.score_quality(d, none).collect()} == {1}
    assert all(r.kept == (not r.base_failed) for r in quality_rules.apply_rules(d, none).collect())
    empty = spark.createDataFrame([], DOCS)
    for f in (toxicity.score_toxicity, quality_mil.score_quality, quality_rules.apply_rules):
        assert f(empty, ls).count() == 0 and f(empty, none).count() == 0


def brute_rules(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(hit))


def test_rule_counts_equal_brute_force(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choices(["a", "b#", "é|", "c\n", "d", "\n\n", "x\x1cy", "<$%"], k=rng.randint(0, 90)))) for i in range(80)]
    docs += [(None, None), (200, ""), (201, "one two\none two\n one two\n\n\n"), (201, "one two\none two\n one two\n\n\n"),
             (202, "same words again " * 30)]
    d, ls = frames(spark, docs, [(i, i % 2, 0, None) for i in range(60)])
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                 for r in quality_rules.apply_rules(d, ls).collect())
    want = []
    for i, t in docs:
        b = brute_rules(t)
        want.append((str(i), *b, b[0] < 50 or 100 * b[4] > 50 * b[0]))
    assert got == sorted(want)


def test_ngrams_of_the_whole_word():
    word = "長い文に空白はない".encode() * 9000  # several slices
    marked = b" " + word + b" "
    want = [zlib.crc32(word), *(zlib.crc32(marked[i:i + k], k) for k in (2, 3, 4) for i in range(len(marked) - k + 1))]
    assert quality_rules.word_features(word) == [x % quality_rules.BUCKETS for x in want]
    rng = np.random.default_rng(7)
    model = quality_rules.RuleModel(rng.normal(size=quality_rules.BUCKETS), 0.5)
    head = bytes(rng.integers(97, 123, 64, dtype=np.uint8))
    words = [head + b"spam" * 60, head + b"prose" * 48, b"short"]
    for w in words:
        share = model.weight[quality_rules.word_features(w)].mean()
        assert model.logit([w], {}) == pytest.approx(0.5 + share)
    assert abs(model.logit([words[0]], {}) - model.logit([words[1]], {})) > 1e-3


def test_attention_gradients():
    rng = np.random.default_rng(4)
    texts = [b"a b c " * 40, b"D!! E!! " * 30, b"", b"x y z " * 100]
    p = quality_mil.Passages(texts, {})
    model = quality_mil.AttentionModel.start()
    mean = rng.normal(size=(len(p.size), quality_mil.WIDTH))
    y, weight = np.array([1.0, 0, 1, 0]), np.array([0.1, 0.4, 0.3, 0.2])

    def loss():
        q = model.forward(p, mean)["p"]
        return -(weight * (y * np.log(q) + (1 - y) * np.log(1 - q))).sum()
    grads, g_mean = model.gradients(p, model.forward(p, mean), y, weight)
    for arr, g in [*((model.w[k], grads[k]) for k in grads), (mean, g_mean)]:
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in arr.shape)
            old = arr[at]
            arr[at] = old + 1e-5
            up = loss()
            arr[at] = old - 1e-5
            down = loss()
            arr[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_platt_recovers_a_logistic():
    rng = np.random.default_rng(2)
    z = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * z - 1)))).astype(float)
    slope, shift = quality_rules.platt(z, y, np.ones(4000))
    assert slope == pytest.approx(0.5, abs=0.06) and shift == pytest.approx(-1, abs=0.15)


def test_sample_is_bounded_and_repeatable(spark):
    docs, labels = made(spark, 100)
    d, ls = frames(spark, docs + [(3, "other text")], labels + [(4, 1, 1, None)])
    a = labelled_sample(d, ls, "toxic", rows=10)
    b = labelled_sample(d.repartition(3), ls.repartition(4), "toxic", rows=10)
    assert a[0] == b[0] and len(a[0]) == 20 and (a[1] == b[1]).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")
def test_held_out_accuracy_on_generated_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    for score, label, least in ((toxicity.score_toxicity, "toxic", 0.88), (quality_mil.score_quality, "quality", 0.95)):
        rows = score(docs, labels).where("held_out").join(labels, "doc_id").collect()
        assert np.mean([r.predicted == r[label] for r in rows]) >= least
    rows = quality_rules.apply_rules(docs, labels).join(labels, "doc_id").where("not base_failed").collect()
    assert np.mean([r.kept == bool(r.quality) for r in rows]) >= 0.95
