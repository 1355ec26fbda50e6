"""The duplicate check past the broadcast bounds, and the spend adapter's joins."""

from conftest import CARD_TYPES, dims, spend_rows

from rewardflow.operators.validate import validate_spend
from rewardflow.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def _validated(spark, rows, **kw):
    d = dims(spark)
    found = validate_spend(spend_rows(spark, rows), d["card_types"], d["exclusions"], CARD_TYPES[0][2], **kw)
    return sorted((r.id, r.reject_reason or "") for r in found.collect())


def test_shuffled_duplicates_agree_with_broadcast_ones(spark):
    ids = ["a", "a", None, None, "b", "c", "c", "c", "d", "a"]
    rows = [dict(transaction_id=t, mcc=None if i in (1, 7) else "5000", amount=f"{i}.00", transaction_date=None if i == 5 else "2021-09-03")
            for i, t in enumerate(ids)]
    small = _validated(spark, rows)
    assert len(small) == len(rows) and _validated(spark, rows, max_broadcast_rows=0) == small
    assert [r[0] for r in small if "uplicate" in r[1]] == ["r0", "r5", "r6", "r9"]


def test_shuffled_duplicates_read_the_rows_once(spark):
    d = tv.dims(spark)
    rows = validate_spend(tv.spend(spark, SF), d["card_types"], d["exclusions"], tv.TENANT, max_broadcast_rows=0)
    p = rows._jdf.queryExecution().optimizedPlan().toString()
    # once for the duplicate keys, once for the rows
    assert p.count("l_orderkey#") and p.count("Relation [l_orderkey") == 2 and "Union" not in p


def test_rows_without_a_key_are_spread(spark):
    rows = [dict(transaction_id=None, amount=f"{i}.00") for i in range(200)]
    d = dims(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = validate_spend(spend_rows(spark, rows), d["card_types"], d["exclusions"], CARD_TYPES[0][2],
                               max_broadcast_rows=-1)
        p = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    rows_by = [ln for ln in p.splitlines() if "hashpartitioning(transaction_id#" in ln and "_place#" in ln]
    assert len(rows_by) == 2, p


def test_customers_are_joined_to_the_orders(spark):
    lines = tv.spend(spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # the join with the customers lies below that of the line items
    depth = {k: next(ln.index("Join") for ln in lines if "Join Inner" in ln and k in ln)
             for k in ("(l_orderkey#", "(o_custkey#")}
    assert depth["(o_custkey#"] > depth["(l_orderkey#"]
