"""The rule frontier, counts taken while writing, and the message sink without repeats."""

import random
import tempfile
from decimal import Decimal

from conftest import dims, rule, spend_rows
from pyspark.sql import functions as F

from rewardflow import schemas as S
from rewardflow.operators.report import observed, observed_report, run_report
from rewardflow.operators.rules import apply_rules, frontier_rules, tier_rules
from rewardflow.operators.validate import validate_spend
from rewardflow.sources import testviews as tv
from rewardflow.streaming.messages import distinct_messages

import datetime as dt


def _random_rules(rng, n):
    out = []
    for _ in range(n):
        kind = rng.choice(["base", "category", "campaign", "both"])
        out.append(rule("base" if kind == "both" else kind, rng.randint(1, 2), rng.randint(-1, 6) / 10,
                        end_date=dt.date(2025, 1, 1) if kind in ("campaign", "both") else None,
                        active=rng.random() < 0.9, foreign=rng.choice([None, True, False]),
                        min_spend=rng.choice([None, 0, 10, 50, 99, 100, 101, 500]),
                        merchant=rng.choice([None, None, "", "sh", "op"]), category=rng.choice([None, None, "k"])))
    return out


def test_frontier_drops_exactly_the_beaten_rules(spark):
    rng = random.Random(6)
    d = dims(spark, rules=_random_rules(rng, 150))
    live = []
    for r in tier_rules(d["rules"]).where("rate > 0").collect():
        live += [(r._r_ct, t, r.fo, r.mu, r.cat, r.mn, r.rate) for t in ("tb", "tc", "tp") if r[t]]
    live = set(live)

    def beaten(a):
        return any(b != a and b[:2] == a[:2] and b[6] >= a[6] and b[5] <= a[5] and (b[2] == a[2] or not b[2])
                   and b[3] in (a[3], None) and b[4] in (a[4], None)
                   # of two alike only the order decides, and no two are alike in a set
                   for b in live)
    want = {a for a in live if not beaten(a)}
    got = {(r._r_ct, t, r.fo, r.mu, r.cat, r.mn, r.rate) for r in frontier_rules(d["rules"]).collect()
           for t in ("tb", "tc", "tp") if r[t]}
    assert got == want and len(got) < len(live)


def test_frontier_form_gives_the_join_forms_rewards(spark):
    rng = random.Random(9)
    d = dims(spark, rules=_random_rules(rng, 400), categories=[("op", 5000, "k")])
    tx = spend_rows(spark, [dict(amount=str(a), currency=c, merchant=m) for a in (5, 50, 99.5, 100, 101, 700)
                            for c in ("SGD", "USD") for m in ("SHOP", "xx", None)])
    v = validate_spend(tx, d["card_types"], d["exclusions"], "t1")
    columns = ["id", "reject_reason", "rate_base", "rate_cat", "rate_camp", "rewardAmountCampaign"]
    got, want = (sorted(map(str, apply_rules(v, d["rules"], d["categories"], form=f, max_array=m)
                            .select(columns).collect())) for f, m in (("auto", 60), ("join", 60)))
    frontier = frontier_rules(d["rules"]).groupBy("_r_ct").count().agg(F.max("count")).first()[0]
    assert frontier <= 60 and got == want


def test_many_rules_take_the_array_form(spark):
    rows = tv.spend(spark, "/root/testdata/sf0.001")
    d = tv.dims(spark)
    # 100,000 rules of four card types: minimums and rates of their own
    k = F.col("id")
    many = spark.range(100_000).select(
        F.when(k % 2 == 0, "base").otherwise("category").alias("title"), (k % 4 + 1).cast("int").alias("card_type_id"),
        F.lit(None).cast("date").alias("end_date"), F.lit(True).alias("is_active"),
        F.lit(None).cast("boolean").alias("is_foreign"),
        (F.pmod(F.xxhash64("id"), F.lit(10 ** 7)) / 100).cast("decimal(18,2)").alias("min_dollar_spent"),
        F.when(k % 3 == 0, "ring").alias("merchant"), F.lit(None).cast("string").alias("custom_category_name"),
        (F.pmod(F.xxhash64(k + 1), F.lit(9000)) / 10000).cast("decimal(10,4)").alias("reward_rate"))
    held: list = []
    v = validate_spend(rows, d["card_types"], d["exclusions"], tv.TENANT)
    out = apply_rules(v, many.to(S.RULE_SCHEMA), d["categories"], cache=held)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "partial_first(_row" not in plan
    assert held[-1].count() < 1000 and out.count() == rows.count()
    for df in held:
        df.unpersist()


def test_counts_come_with_the_write(spark):
    d = dims(spark, rules=[rule("base", 1, Decimal("0.1"))])
    tx = spend_rows(spark, [{}, {"mcc": None}, {"amount": "n/a"}, {"transaction_id": "t0"}, {}])
    v = validate_spend(tx, d["card_types"], d["exclusions"], "t1")
    for rows in (apply_rules(v, d["rules"], d["categories"]), apply_rules(v.limit(0), d["rules"], d["categories"])):
        counted, counts = observed(rows)
        counted.write.parquet(tempfile.mkdtemp(prefix="rf-obs-", dir="/tmp") + "/x")
        got, want = observed_report(spark, counts, "f", "e/"), run_report(rows, "f", "e/")
        assert got.collect() == want.collect() and got.columns == want.columns


def test_repeated_messages_pass_once(spark):
    def batch(keys):
        return spark.createDataFrame([(k, f"m{k}") for k in keys], "messageKey string, body string").repartition(2)
    got = distinct_messages(spark, [batch(["a", "b", "a", None]), batch(["b", "c", None]), batch(["a"])])
    assert sorted((r.messageKey or "") for r in got.collect()) == ["", "a", "b", "c"]
