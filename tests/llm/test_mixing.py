import re

import pytest

from rewardflow.llm.mixing import plan_mix, source_targets, training_order

DOCS = "doc_id long, text string, source string, size string, target string, _row long, positions string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", 1, "z") for i, t, s in rows], DOCS)


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, cap=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), share * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        give = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            target[s] += give[s]
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = cap * sizes[s]
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 500, "c": 20, "d": 1000, None: 7}, {"a": 0, "b": 5},
    {"z": 3}, {"é": 50, "z": 1, "Z": 900, "": 40, None: 0}])
def test_targets_equal_repeated_resharing(spark, sizes):
    df = spark.createDataFrame([(s is None, s or "", n) for s, n in sizes.items()],
                               "_null boolean, _source string, source_size long")
    got = {(None if r._null else r._source): r.target for r in source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got == pytest.approx(want)


def test_rows_nulls_ties_and_clashing_columns(spark):
    rows = [(i, "w " * (i % 7 + 1), "abc"[i % 3]) for i in range(300)]
    rows += [(None, None, None), (None, "", "a"), (5, "x\x1cy z", "a"), (5, "x\x1cy z", "a"), (9, "one " * 4000, None)]
    keep = ("doc_id", "source")
    out = plan_mix(docs_of(spark, rows), keep).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.taken in (0, r.size, 2 * r.size) and len(r.positions) * r.size == r.taken
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
    by = {}
    for i, t, s in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        by.setdefault(s, []).append(n)
    want = brute_targets({s: sum(n) for s, n in by.items()})
    for s, ns in by.items():
        mine = [r for r in out if r.source == s]
        assert sorted(r.size for r in mine) == sorted(ns)
        assert {(r.source_size, r.target) for r in mine} == {(sum(ns), want[s])}
        assert abs(sum(r.taken for r in mine) - want[s]) <= max(ns) / 2
    again = plan_mix(docs_of(spark, rows[::-1]).repartition(7), keep).collect()
    key = lambda r: (str(r.doc_id), r.size, r.source_size, r.taken, r.positions)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_positions_follow_the_schedule(spark):
    rows = [(i, "w", "s") for i in range(2000)]
    knots = ((0.0, 0.0), (1.0, 2.0))
    plan = plan_mix(docs_of(spark, rows), schedules=(knots,), share=1.0)
    order = training_order(plan).collect()
    assert len(order) == 2000
    for k in (100, 1000, 1900):  # demand t^2 words of the whole by time t
        assert order[k].position == pytest.approx(((k + 0.5) / 2000) ** 0.5, abs=1e-9)


def test_empty_table(spark):
    assert plan_mix(docs_of(spark, [])).count() == 0
