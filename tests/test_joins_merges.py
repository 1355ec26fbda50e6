"""The inverted substring join, the hash-slot duplicate check and the bucketed merge."""

import os
import random
import tempfile
from collections import Counter

from pyspark.sql import functions as F

from rewardflow.operators.bucketed import BucketedTable
from rewardflow.operators.categories import merchant_categories
from rewardflow.operators.substring import substring_join, substring_matches
from rewardflow.operators.validate import duplicate_keys, duplicate_keys_by_slot
from rewardflow.session import scratch_path


def test_substring_join_equals_brute_force(spark):
    rng = random.Random(2)
    word = lambda a, b: "".join(rng.choice("abAB é") for _ in range(rng.randint(a, b)))
    rows = [(i, rng.randint(1, 3), word(0, 9)) for i in range(150)] + [(900, 1, None), (901, None, "ab")]
    rows += [(i, 1, "hot text abab") for i in range(1000, 1200)]  # one text holds most rows
    pats = [(k, rng.randint(1, 3), word(0, 5)) for k in range(80)]
    pats += [(100, 1, ""), (101, 1, None), (102, None, "a"), (103, 1, "AB"), (103, 1, "AB"), (104, 2, "zzzz")]
    a = spark.createDataFrame(rows, "id int, m int, t string").repartition(3)
    b = spark.createDataFrame(pats, "pid int, n int, p string")
    want = Counter((i, k) for i, m, t in rows for k, n, p in pats
                   if None not in (m, t, n, p) and m == n and p.upper() in t.upper())
    for most in (200_000, 1):  # broadcast and shuffle joins
        got = substring_join(a, b, "t", "p", [("m", "n")], max_broadcast_rows=most)
        assert Counter((r.id, r.pid) for r in got.collect()) == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    free = Counter((i, k) for i, _, t in rows for k, _, p in pats if None not in (t, p) and p.upper() in t.upper())
    assert Counter((r.id, r.pid) for r in substring_join(a, b, "t", "p").collect()) == free
    none = b.limit(0)
    assert substring_join(a, none, "t", "p", [("m", "n")]).count() == 0
    assert substring_join(a.limit(0), b, "t", "p", [("m", "n")]).count() == 0


def test_patterns_without_a_possible_text_drop_out(spark):
    t = spark.createDataFrame([("abcdef",), ("bcdefg",)], "text string")
    p = spark.createDataFrame([("abcq",), ("cde",), ("fgh",)], "pattern string")
    got = {(r.text, r.pattern) for r in substring_matches(t, p).collect()}
    assert got == {("abcdef", "cde"), ("bcdefg", "cde")}


def test_category_forms_agree(spark):
    rows = spark.createDataFrame([(1, 5, "Blue Ring"), (2, 5, None), (3, 6, "ring"), (4, None, "ring"), (5, 5, "ring ring")],
                                 "id int, mcc_int int, merchant string")
    cats = spark.createDataFrame([("RING", 5, "j"), ("ring", 5, "k"), ("b", 5, "c"), (None, 5, "x"), ("ring", None, "y"),
                                  ("RING", 5, "j")], "name string, mcc int, merchant string")
    one, two = (Counter(map(tuple, merchant_categories(rows, cats, form=f).select(
        "id", "mcc_int", "merchant", "pattern", "category").collect())) for f in ("test", "grams"))
    assert one == two and sum(one.values()) == 7


def _shuffled(spark, make):
    """Rows' result and shuffle bytes written, by the plan's own metrics."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = make()
        rows = df.collect()
        total, todo = 0, [df._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            metric = node.metrics().get("shuffleBytesWritten")
            total += metric.get().value() if metric.isDefined() else 0
            todo += [node.children().apply(i) for i in range(node.children().size())]
        return rows, total
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_slots_find_the_same_duplicates_and_shuffle_less(spark):
    uid = F.sha2(F.col("id").cast("string"), 256)
    tx = spark.range(0, 60_000, 1, 6).select(uid.alias("transaction_id"), F.lit("1").alias("mcc"),
                                             F.lit("s3://bucket/a/long/path/to/a/file.csv").alias("source_file"))
    keys = ["source_file", "transaction_id"]
    some = tx.unionByName(tx.limit(500)).unionByName(tx.limit(3).withColumn("source_file", F.lit("other")))
    some = some.unionByName(spark.createDataFrame([(None, "1", "f"), (None, "1", "f"), ("x", None, "f"), ("x", None, "f")],
                                                  "transaction_id string, mcc string, source_file string"))
    plain = {tuple(r) for r in duplicate_keys(some, keys).collect()}
    assert len(plain) == 500 and {tuple(r) for r in duplicate_keys_by_slot(some, keys).collect()} == plain
    assert {tuple(r) for r in duplicate_keys_by_slot(some, keys, max_broadcast_rows=10).collect()} == plain
    held = []
    # unique input: the slots' own shuffle, then nothing
    (a, by_key) = _shuffled(spark, lambda: duplicate_keys(tx, keys))
    slot = F.xxhash64(*keys)
    (_, by_slot) = _shuffled(spark, lambda: tx.groupBy(slot.alias("s")).count().where("count > 1"))
    (b, rest) = _shuffled(spark, lambda: duplicate_keys_by_slot(tx, keys, cache=held))
    for df in held:
        df.unpersist()
    assert a == b == [] and 0 < by_slot + rest < by_key / 2, (by_slot, rest, by_key)


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_bucketed_merge_rewrites_only_changed_buckets(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="rf-bkt-", dir="/tmp"), "t")
    table = BucketedTable(spark, path, ["k", "tenant"], buckets=16)
    schema = "k long, tenant string, email string, note string"
    rows = {(i, "a"): (f"e{i}", f"n{i}") for i in range(300)}
    table.create(spark.createDataFrame([(*k, *v) for k, v in rows.items()], schema))
    before = _files(path)
    src = [(7, "a", "new7"), (1000, "a", None), (8, "a", "e8")]  # an update, an insert, no change
    source = spark.createDataFrame(src, "k int, tenant string, email string")
    written = table.merge(source, ["email"])
    after = _files(path)
    touched = {f"_bucket={b}" for b in written}
    assert 1 <= len(written) <= 2
    assert {f for f in before if f.split("/")[-2] not in touched} <= after
    assert not {f for f in before if f.split("/")[-2] in touched} & after
    want = {**rows, (7, "a"): ("new7", "n7"), (1000, "a"): (None, None)}
    assert {(r.k, r.tenant): (r.email, r.note) for r in table.read().collect()} == want
    # again: nothing differs, nothing is written
    assert table.merge(source, ["email"]) == [] and _files(path) == after
    assert table.merge(source.limit(0), ["email"]) == []
    # insert if absent
    assert table.merge(spark.createDataFrame([(7, "a", "x"), (2000, "b", "y")], "k int, tenant string, email string"), [])
    want[(2000, "b")] = ("y", None)
    assert {(r.k, r.tenant): (r.email, r.note) for r in table.read().collect()} == want


def test_bucketed_table_path_is_shared(spark):
    assert scratch_path(spark, "x").startswith(spark.sparkContext.getCheckpointDir())
