"""Users split, stable dedupe, merges, insert-if-absent, ids, FK lookup."""

from pyspark.sql import functions as F

from rewardflow import schemas as S
from rewardflow.operators.ids import assign_ids
from rewardflow.operators.onboard import dedupe, prepare_users, split_users
from rewardflow.operators.upsert import (insert_if_absent, merge_upsert, resolve_card_type_id,
                                         split_null_keys)
from rewardflow.plans.users import users_run
from rewardflow.sources.testviews import local_table


def users(spark, rows):
    base = dict(id="1", first_name="Ann", last_name="Lee", email="a@x", phone="1", card_id="c1",
                card_pan="5111", card_type="scis_shopping", created_at="2021-01-01")
    out = []
    for r in rows:
        d = dict(base)
        d.update(r)
        out.append(tuple(d[c] for c in S.USER_COLUMNS))
    return spark.createDataFrame(out, S.USER_SCHEMA)


def test_prepare_users_name_and_reward_type(spark):
    u = prepare_users(users(spark, [{}, dict(last_name=None), dict(card_type="other"),
                                     dict(card_type=None)]), "acme")
    rows = u.collect()
    assert "card_pan" not in u.columns
    assert [r["name"] for r in rows] == ["Ann Lee", None, "Ann Lee", "Ann Lee"]
    assert [r["REWARD_TYPE"] for r in rows] == ["points", "points", None, None]
    assert {r["TENANT"] for r in rows} == {"acme"}


def test_dedupe_stable_winner_and_null_keys_group(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), (None, "z"), (None, "y")], "k string, v string")
    got = {r["k"]: r["v"] for r in dedupe(df, ["k"], ["k", "v"]).collect()}
    assert got == {"k": "a", None: "y"}
    last = {r["k"]: r["v"] for r in dedupe(df, ["k"], ["k", "v"], keep="last").collect()}
    assert last == {"k": "b", None: "z"}


def test_merge_upsert_updates_inserts_keeps_and_is_idempotent(spark):
    tgt = spark.createDataFrame([("1", "old@x", "acme"), ("2", "two@x", "acme"), ("1", "o@x", "other")],
                                S.CARD_CUSTOMER_SCHEMA)
    src = spark.createDataFrame([("1", "new@x", "acme"), ("3", "three@x", "acme")],
                                S.CARD_CUSTOMER_SCHEMA)
    out = merge_upsert(tgt, src, ["customer_id", "tenant"], ["email"])
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("1", "new@x", "acme"), ("1", "o@x", "other"), ("2", "two@x", "acme"),
                   ("3", "three@x", "acme")]
    again = merge_upsert(out, src, ["customer_id", "tenant"], ["email"])
    assert sorted(tuple(r) for r in again.collect()) == got


def test_null_keys_are_rejected_before_merge(spark):
    src = spark.createDataFrame([("1", "a", "acme"), (None, "b", "acme")], S.CARD_CUSTOMER_SCHEMA)
    ok, bad = split_null_keys(src, ["customer_id", "tenant"])
    assert ok.count() == 1
    assert [r["reject_reason"] for r in bad.collect()] == ["customer_id is empty!"]


def test_insert_if_absent_assigns_ids_after_max(spark):
    tgt = local_table(spark, [(1, "a", "acme"), (5, "b", "acme")], S.CARD_TYPE_SCHEMA)
    src = spark.createDataFrame([("b", "acme"), ("d", "acme"), ("c", "acme"), ("a", "x")],
                                "name string, tenant string")
    out = insert_if_absent(tgt, src, ["name", "tenant"], id_col="id")
    got = sorted((r["id"], r["name"], r["tenant"]) for r in out.collect())
    assert got == [(1, "a", "acme"), (5, "b", "acme"), (6, "a", "x"), (7, "c", "acme"), (8, "d", "acme")]


def test_assign_ids_dense_in_order_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    out = assign_ids(df, "rid", ["k"], start=100, num_partitions=5)
    rows = out.collect()
    assert sorted(r["rid"] for r in rows) == list(range(101, 5101))
    assert all(r["rid"] == 101 + r["k"] for r in rows)


def test_fk_lookup_by_name_and_tenant(spark):
    ct = local_table(spark, [(1, "scis_shopping", "acme"), (2, "scis_shopping", "other")],
                     S.CARD_TYPE_SCHEMA)
    src = spark.createDataFrame([("Ann", "scis_shopping", "acme"), ("Bob", "nope", "acme")],
                                "name string, card_type string, TENANT string")
    ok, bad = resolve_card_type_id(src, ct)
    assert [(r["name"], r["card_type_id"]) for r in ok.collect()] == [("Ann", 1)]
    assert [r["reject_reason"] for r in bad.collect()] == ["No card type ID detected!"]


def test_users_run_end_to_end(spark):
    u = users(spark, [dict(id="1", card_id="c1", card_type="scis_shopping"),
                      dict(id="1", card_id="c1", card_type="scis_shopping", email="b@x"),
                      dict(id="2", first_name="Bo", card_id="c2", card_type="scis_new"),
                      dict(id="3", first_name="Cy", card_id="c3", card_type=None)])
    targets = {
        "card_customers": spark.createDataFrame([("1", "old@x", "acme")], S.CARD_CUSTOMER_SCHEMA),
        "cards": spark.createDataFrame([], S.CARD_SCHEMA),
        "card_types": local_table(spark, [(1, "scis_shopping", "acme")], S.CARD_TYPE_SCHEMA),
        "campaign_customers": spark.createDataFrame([], S.CAMPAIGN_CUSTOMER_SCHEMA),
    }
    run = users_run(u, "acme", targets)
    cust = {r["customer_id"]: r["email"] for r in run.customers.collect()}
    assert cust == {"1": "a@x", "2": "a@x", "3": "a@x"}
    types = sorted((r["id"], r["name"]) for r in run.card_types.collect())
    assert types == [(1, "scis_shopping"), (2, "scis_new")]
    camp = sorted((r["name"], r["card_type_id"]) for r in run.campaign_customers.collect())
    assert camp == [("Ann Lee", 1), ("Bo Lee", 2)]
    rej = sorted((r["table_name"], r["reject_reason"]) for r in run.rejects.collect())
    assert rej == [("campaign_customer", "No card type ID detected!"), ("card_type", "name is empty!")]
    parts = split_users(u, "acme")
    assert parts.customers.count() == 3 and parts.cards.count() == 3


def test_merge_broadcast_and_shuffle_paths_agree(spark):
    tgt = spark.createDataFrame([(str(i), f"old{i}", "acme" if i % 3 else "other") for i in range(40)],
                                S.CARD_CUSTOMER_SCHEMA)
    src = spark.createDataFrame([(str(i), f"new{i}", "acme") for i in range(20, 60)],
                                S.CARD_CUSTOMER_SCHEMA)
    keys = ["customer_id", "tenant"]
    small = merge_upsert(tgt, src, keys, ["email"])
    big = merge_upsert(tgt, src, keys, ["email"], max_broadcast_rows=1)
    a = sorted(tuple(r) for r in small.collect())
    assert a == sorted(tuple(r) for r in big.collect())
    assert len(a) == 40 + 40 - sum(1 for i in range(20, 40) if i % 3)
    p = small._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in p
    from rewardflow.operators.upsert import new_rows
    n1 = sorted(tuple(r) for r in new_rows(tgt, src, keys).collect())
    n2 = sorted(tuple(r) for r in new_rows(tgt, src, keys, max_broadcast_rows=1).collect())
    assert n1 == n2 and len(n1) == 40 - sum(1 for i in range(20, 40) if i % 3)


def test_latest_row_wins_and_null_never_beats_a_value(spark):
    from rewardflow.operators.onboard import split_users
    rows = [("1", "A", "L", "old@x", "9", "c1", "5", "t", "2021-01-01"), ("1", "A", "L", "new@x", "9", "c1", "5", "t", "2021-03-01"),
            ("2", "B", "L", None, "8", "c2", "5", "t", "2021-02-01"), ("2", "B", "L", "b@x", "8", "c2", "5", "t", "2021-02-01"),
            ("3", "C", "L", "c@x", "7", "c3", "5", "t", None), ("3", "C", "L", "c2@x", "7", "c3", "5", "t", "2020-01-01")]
    users = spark.createDataFrame(rows, S.USER_SCHEMA)
    got = lambda **kw: {r["id"]: r["email"] for r in split_users(users, "acme", **kw).customers.collect()}
    assert got(order=["created_at"], keep="last") == {"1": "new@x", "2": "b@x", "3": "c2@x"}
    assert got(order=["created_at"]) == {"1": "old@x", "2": "b@x", "3": "c2@x"}
    assert got()["2"] == "b@x"


def test_duplicate_card_type_names_are_listed(spark):
    from rewardflow.operators.validate import duplicate_card_types
    ct = spark.createDataFrame([(2, "a", "t"), (1, "a", "t"), (1, "a", "u"), (3, "b", "t")], S.CARD_TYPE_SCHEMA)
    assert [tuple(r) for r in duplicate_card_types(ct).collect()] == [("t", "a", [1, 2])]
