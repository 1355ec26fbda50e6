"""One case per branch of the reward rules (hand-worked expected values)."""

from decimal import Decimal

import pytest

from conftest import dims, rule, spend_rows
from rewardflow.operators.messages import to_messages
from rewardflow.plans.spend import process_spend


def run(spark, rows, d, form="auto", max_rows=200_000):
    res = process_spend(spend_rows(spark, rows), d["card_types"], d["exclusions"], d["rules"],
                        d["categories"], "t1", form=form, max_broadcast_rows=max_rows)
    return {r["id"]: r for r in res.collect()}, res


def reason(spark, rows, d=None):
    out, _ = run(spark, rows, d or dims(spark))
    return {k: v["reject_reason"] for k, v in out.items()}


def test_blank_and_space_mcc(spark):
    r = reason(spark, [dict(mcc=None), dict(mcc=" "), dict(mcc="0742")])
    assert r == {"r0": "MCC is empty!", "r1": "Error in processing: mcc", "r2": None}


def test_duplicates_all_copies_rejected_after_mcc_check(spark):
    r = reason(spark, [dict(transaction_id="a"), dict(transaction_id="a"),
                       dict(transaction_id="b"), dict(transaction_id="b", mcc=None)])
    assert r == {"r0": "Duplicate rows", "r1": "Duplicate rows", "r2": None, "r3": "MCC is empty!"}


def test_null_transaction_id_and_unknown_card_type(spark):
    r = reason(spark, [dict(transaction_id=None), dict(card_type="none"), dict(card_type=None)])
    assert r == {"r0": "Transaction ID is empty!", "r1": "Card type not registered in DB!",
                 "r2": "Card type not registered in DB!"}


def test_card_type_of_other_tenant_not_registered(spark):
    d = dims(spark)
    out, _ = run(spark, [dict(card_type="shop")], d)
    assert out["r0"]["cardTypeId"] == 1


def test_exclusion_wins_over_currency_and_date(spark):
    d = dims(spark, exclusions=[(1, 6011, "t1")])
    out, res = run(spark, [dict(mcc="6011", currency="EUR", transaction_date="3/9/2021"),
                           dict(mcc="6011", currency=None)], d)
    assert out["r0"]["reject_reason"] is None
    assert out["r0"]["remark"] == "No reward due to exclusion - 6011"
    assert out["r0"]["rewardAmountBase"] == 0
    assert out["r1"]["reject_reason"] == "Error in processing: currency"
    msgs = to_messages(res, "t1").collect()
    assert len(msgs) == 1 and msgs[0]["rewardAmount"] == Decimal("0.00")
    assert msgs[0]["remarks"] == "No reward due to exclusion - 6011" and msgs[0]["tenant"] == "T1"


def test_currency_and_date_and_amount_reasons(spark):
    r = reason(spark, [dict(currency="EUR"), dict(transaction_date="3/9/2021"),
                       dict(transaction_date=None), dict(amount="abc")])
    assert r == {"r0": "EUR is not in currency mapping!",
                 "r1": "Date format should be yyyy-mm-dd: 3/9/2021",
                 "r2": "Error in processing: transaction_date",
                 "r3": "Error in processing: amount"}


def test_foreign_rounding_half_even_and_lower_case_sgd(spark):
    out, _ = run(spark, [dict(currency="USD", amount="10.00"), dict(currency="USD", amount="30.00"),
                         dict(currency="sgd", amount="10.50"), dict(currency="SGD", amount="10.50")],
                 dims(spark))
    assert out["r0"]["amount_sgd"] == Decimal("14")
    assert out["r1"]["amount_sgd"] == Decimal("40")
    assert out["r2"]["amount_sgd"] == Decimal("10") and out["r2"]["is_foreign"]
    assert out["r3"]["amount_sgd"] == Decimal("10.50") and not out["r3"]["is_foreign"]


def test_compounding_tiers(spark):
    d = dims(spark, rules=[rule("base", 3, 2), rule("category", 3, 3),
                           rule("campaign", 3, 0.5, end_date=__import__("datetime").date(2030, 1, 1))])
    out, res = run(spark, [dict(card_type="plat", amount="100.00")], d)
    r = out["r0"]
    assert (r["rewardAmountBase"], r["rewardAmountCat"], r["rewardAmountCampaign"]) == (
        Decimal("200"), Decimal("600"), Decimal("300"))
    assert r["remark"] == ("Base reward giving 2.0 miles/SGD,Category reward giving 3.0 miles/SGD,"
                           "Campaign reward giving 0.5 miles/SGD,")
    assert len(to_messages(res, "t1").collect()) == 3


def test_threshold_uses_running_amount_and_skipped_tier(spark):
    d = dims(spark, rules=[rule("base", 3, 0.01), rule("category", 3, 2, min_spend=50)])
    out, _ = run(spark, [dict(card_type="plat")], d)
    assert out["r0"]["rate_cat"] is None and out["r0"]["rewardAmountCat"] == 0
    d2 = dims(spark, rules=[rule("category", 3, 3)])
    out2, res2 = run(spark, [dict(card_type="plat")], d2)
    assert out2["r0"]["rewardAmountBase"] == 0 and out2["r0"]["rewardAmountCat"] == Decimal("300")
    msgs = to_messages(res2, "t1").collect()
    assert [m["tier"] for m in msgs] == ["category"]


def test_foreign_only_rule(spark):
    d = dims(spark, rules=[rule("base", 2, 4, foreign=True)])
    out, _ = run(spark, [dict(card_type="free", currency="SGD"),
                         dict(card_type="free", currency="USD", amount="100.00")], d)
    assert out["r0"]["rate_base"] is None
    assert out["r1"]["rate_base"] == Decimal("4") and out["r1"]["rewardAmountBase"] == Decimal("540")


def test_merchant_substring_and_category(spark):
    d = dims(spark, rules=[rule("base", 2, 2, merchant="grab"), rule("category", 2, 3, category="food")],
             categories=[("grab", 5812, "food")])
    out, _ = run(spark, [dict(card_type="free", merchant="GRAB FOOD", mcc="5812"),
                         dict(card_type="free", merchant="GRAB FOOD", mcc="5813"),
                         dict(card_type="free", merchant="TAXI", mcc="5812")], d)
    assert (out["r0"]["rate_base"], out["r0"]["rate_cat"]) == (Decimal("2"), Decimal("3"))
    assert (out["r1"]["rate_base"], out["r1"]["rate_cat"]) == (Decimal("2"), None)
    assert (out["r2"]["rate_base"], out["r2"]["rate_cat"]) == (None, None)


def test_rule_in_two_tiers_and_non_positive_rates(spark):
    import datetime
    d = dims(spark, rules=[rule("base", 4, 2, end_date=datetime.date(2020, 1, 1)),
                           rule("category", 4, 0), rule("category", 4, -1),
                           rule("campaign", 4, 9, end_date=datetime.date(2020, 1, 1), active=False)])
    out, _ = run(spark, [dict(card_type="prem")], d)
    r = out["r0"]
    assert (r["rate_base"], r["rate_cat"], r["rate_camp"]) == (Decimal("2"), None, Decimal("2"))
    assert r["rewardAmountCampaign"] == Decimal("400")


def test_unit_missing_and_no_rule(spark):
    d = dims(spark, rules=[rule("base", 5, 1)])
    r = reason(spark, [dict(card_type="extra")], d)
    assert r == {"r0": "Error in processing: reward unit"}
    out, res = run(spark, [dict(card_type="prem")], dims(spark))
    assert out["r0"]["reject_reason"] is None and to_messages(res, "t1").count() == 0


def test_remark_text_percent_and_plain(spark):
    d = dims(spark, rules=[rule("base", 1, 0.05), rule("base", 2, 4)])
    out, _ = run(spark, [dict(card_type="shop"), dict(card_type="free")], d)
    assert out["r0"]["remark_base"] == "Base reward giving 5.0 cashback/SGD"
    assert out["r1"]["remark_base"] == "Base reward giving 4.0 miles/SGD"


def test_null_merchant_with_merchant_rule_rejected(spark):
    d = dims(spark, rules=[rule("base", 2, 2, merchant="grab")])
    r = reason(spark, [dict(card_type="free", merchant=None), dict(card_type="prem", merchant=None)], d)
    assert r == {"r0": "Error in processing: merchant", "r1": None}


def test_array_and_join_forms_agree(spark):
    import datetime
    d = dims(spark, rules=[rule("base", 1, 0.01), rule("base", 1, 0.02, foreign=True),
                           rule("category", 1, 0.05, category="food"),
                           rule("campaign", 1, 2, end_date=datetime.date(2030, 1, 1), merchant="grab")],
             categories=[("grab", 5812, "food")])
    rows = [dict(card_type="shop", merchant=m, mcc=mcc, currency=c, amount=a)
            for m in ("GRAB", "TAXI") for mcc in ("5812", "1") for c in ("SGD", "USD")
            for a in ("10.00", "999.99")]
    a, _ = run(spark, rows, d, "array")
    j, _ = run(spark, rows, d, "join")
    # nothing may be broadcast: shuffle joins everywhere, categories by semi-join
    u, res = run(spark, rows, d, "auto", max_rows=0)
    assert a == j == u
    p = res._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in p


def test_invariants(spark):
    rows = [dict(mcc=None), dict(transaction_id="x"), dict(transaction_id="x"), dict(currency="EUR"), {}]
    _, res = run(spark, rows, dims(spark, rules=[rule("base", 1, 0.1)]))
    from rewardflow.operators.report import run_report
    rep = run_report(res, "f.csv", "err/").collect()[0]
    assert rep["numberOfRows"] == rep["numberOfProcessed"] + rep["numberOfRejected"] == 5
    assert rep["numberOfRejected"] == 4 and rep["errorFileURL"] == "err/"


def test_rate_table_equals_rate_map(spark):
    from rewardflow import schemas as S
    from rewardflow.sources.testviews import local_table
    rows = [dict(currency="USD", amount="10.00"), dict(currency="sgd", amount="10.50"),
            dict(currency="EUR"), dict(currency="usd", amount="30.00")]
    d = dims(spark, rules=[rule("base", 1, 0.1)])
    tx = spend_rows(spark, rows)
    table = local_table(spark, [("USD", Decimal("1.35")), ("sgd", Decimal("1"))], S.RATE_SCHEMA)
    a = process_spend(tx, d["card_types"], d["exclusions"], d["rules"], d["categories"], "t1")
    b = process_spend(tx, d["card_types"], d["exclusions"], d["rules"], d["categories"], "t1",
                      rates=table)
    cols = ["id", "reject_reason", "amount_sgd", "rewardAmountBase"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    got = {r["id"]: r["amount_sgd"] for r in b.collect()}
    assert got["r0"] == Decimal("14") and got["r3"] == Decimal("40") and got["r2"] is None


# ---- exact money ---------------------------------------------------------------
def _scored(spark, rows, rules, **kw):
    d = dims(spark, rules)
    df = process_spend(spend_rows(spark, rows), d["card_types"], d["exclusions"], d["rules"],
                       d["categories"], "t1", **kw)
    return {r["id"]: r for r in df.collect()}


def test_amounts_are_not_rounded_before_the_reward(spark):
    got = _scored(spark, [dict(amount="10.555"), dict(amount="1e3"), dict(amount="2.5E-1")], [rule("base", 1, 2)])
    assert [float(got[f"r{i}"]["rewardAmountBase"]) for i in range(3)] == [21.11, 2000.0, 0.5]


@pytest.mark.parametrize("as_table", [False, True])
def test_small_and_zero_conversion_rates(spark, as_table):
    rates = {"IDR": "0.000085", "VND": "0.00004", "XXX": "0", "SGD": "1"}
    if as_table:
        rates = spark.createDataFrame(list(rates.items()), "currency string, rate string")
    got = _scored(spark, [dict(currency="IDR", amount="1000000"), dict(currency="VND", amount="1000000"),
                          dict(currency="XXX")], [rule("base", 1, 1)], rates=rates)
    assert float(got["r0"]["amount_sgd"]) == 85 and float(got["r1"]["amount_sgd"]) == 40
    assert got["r2"]["reject_reason"] == "XXX is not in currency mapping!"


@pytest.mark.parametrize("form", ["array", "join"])
def test_overflow_rejects_the_row_and_not_the_job(spark, form):
    big = "9999999999999999.99"
    rows = [dict(amount=big), dict(amount="9" * 18), dict(amount="9" * 19), dict(amount="5")]
    rules = [rule("base", 1, 2), rule("category", 1, 9000)]
    got = _scored(spark, rows, rules, form=form)
    assert [got[f"r{i}"]["reject_reason"] for i in range(4)] == ["Error in processing: amount"] * 3 + [None]
    one = _scored(spark, rows[:1], rules[:1], form=form)["r0"]
    assert one["reject_reason"] is None and str(one["rewardAmountBase"]) == "19999999999999999.980000"
    d = dims(spark, rules[:1])
    from rewardflow.operators.messages import to_messages
    msg = to_messages(process_spend(spend_rows(spark, rows[:1]), d["card_types"], d["exclusions"], d["rules"],
                                    d["categories"], "t1", form=form), "t1").collect()
    assert str(msg[0]["rewardAmount"]) == "19999999999999999.98"


def test_a_card_type_without_a_unit_rejects_only_rewarded_rows(spark):
    rules = [rule("base", 5, 1, min_spend=50)]
    got = _scored(spark, [dict(card_type="extra", amount="100"), dict(card_type="extra", amount="10")], rules)
    assert got["r0"]["reject_reason"] == "Error in processing: reward unit" and got["r1"]["reject_reason"] is None


def test_large_arrays_take_the_join_form(spark):
    rules = [rule("base", 1, 1), rule("category", 1, 3, min_spend=5), rule("campaign", 2, 2, end_date=None)]
    rows = [dict(amount="7"), dict(amount="3"), dict(card_type="free")]
    d = dims(spark, rules)

    def run(**kw):
        from rewardflow.operators.rules import apply_rules
        from rewardflow.operators.validate import validate_spend
        v = validate_spend(spend_rows(spark, rows), d["card_types"], d["exclusions"], "t1")
        return sorted(map(str, apply_rules(v, d["rules"], d["categories"], form="array", **kw).collect()))
    assert run() == run(max_array=1) == run(max_broadcast_rows=0)
