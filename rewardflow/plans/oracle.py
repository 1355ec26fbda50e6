"""DuckDB SQL for every registered query, written independently of the Spark
plans, over the pre-registered views ``lineitem orders customer part``.

The spend and user adapters, the literal dimensions and the pipeline are
CTEs; each query is a final SELECT over them. The rule tiers are correlated
``max`` subqueries chained through the running amount.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from .. import fixed as X
from .. import schemas as S
from ..sources import testviews as tv

T = tv.TENANT


def _lit(v, typ: str) -> str:
    if v is None:
        return f"CAST(NULL AS {typ})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, Decimal)):
        return f"CAST({v} AS {typ})"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return "'" + str(v).replace("'", "''") + "'"


def _values(rows, cols: list[tuple[str, str]]) -> str:
    body = ",\n    ".join("(" + ", ".join(_lit(v, t) for v, (_, t) in zip(r, cols)) + ")" for r in rows)
    names = ", ".join(c for c, _ in cols)
    return f"SELECT * FROM (VALUES\n    {body}) AS v({names})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


CT_COLS = [("id", "INTEGER"), ("name", "VARCHAR"), ("tenant", "VARCHAR")]
DIMS = {
    "card_types_dim": _values(tv.CARD_TYPES, CT_COLS),
    "exclusions_dim": _values(tv.EXCLUSIONS, [("card_type_id", "INTEGER"), ("mcc_mcc", "INTEGER"),
                                              ("tenant", "VARCHAR")]),
    "rules_dim": _values(tv.RULES, [
        ("title", "VARCHAR"), ("card_type_id", "INTEGER"), ("end_date", "DATE"),
        ("is_active", "BOOLEAN"), ("is_foreign", "BOOLEAN"), ("min_dollar_spent", "DECIMAL(18,2)"),
        ("merchant", "VARCHAR"), ("custom_category_name", "VARCHAR"), ("reward_rate", "DECIMAL(10,4)")]),
    "categories_dim": _values(tv.CATEGORIES, [("name", "VARCHAR"), ("mcc", "INTEGER"),
                                              ("merchant", "VARCHAR")]),
    "campaign_card_types_dim": _values(tv.CAMPAIGN_CARD_TYPES, CT_COLS),
}

_RATE_CASE = ("CASE upper(currency) " + " ".join(
    f"WHEN {_q(k.upper())} THEN CAST({v} AS DECIMAL(10,4))" for k, v in X.CURRENCY_RATES.items())
    + " END")
_UNIT_CASE = ("CASE cardTypeId " + " ".join(
    f"WHEN {k} THEN {_q(v)}" for k, v in X.REWARD_UNITS.items()) + " END")
_REWARD_TYPE_CASE = ("CASE card_type " + " ".join(
    f"WHEN {_q(k)} THEN {_q(v)}" for k, v in X.REWARD_TYPE_MAP.items()) + " END")

SPEND = r"""
spend AS (
  SELECT
    concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR), CAST(l.l_partkey AS VARCHAR)) AS id,
    CASE WHEN l.l_partkey % 97 = 0 THEN NULL
         ELSE concat_ws('-', CAST(l.l_orderkey AS VARCHAR), CAST(l.l_linenumber AS VARCHAR)) END AS transaction_id,
    CASE WHEN l.l_partkey % 101 = 0 THEN NULL ELSE p.p_name END AS merchant,
    CASE WHEN p.p_size = 50 THEN NULL WHEN p.p_size = 49 THEN 'x' ELSE CAST(p.p_size AS VARCHAR) END AS mcc,
    CASE WHEN l.l_partkey % 103 = 0 THEN NULL
         WHEN l.l_suppkey % 10 < 6 THEN 'SGD' WHEN l.l_suppkey % 10 < 8 THEN 'USD'
         WHEN l.l_suppkey % 10 = 8 THEN 'sgd' ELSE 'EUR' END AS currency,
    CASE WHEN l.l_partkey % 89 = 0 THEN 'n/a'
         ELSE CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
    CASE WHEN l.l_suppkey % 17 = 0 THEN strftime(l.l_shipdate, '%-d/%-m/%Y')
         ELSE strftime(l.l_shipdate, '%Y-%m-%d') END AS transaction_date,
    CAST(o.o_custkey AS VARCHAR) AS card_id,
    '4' || lpad(CAST(o.o_custkey AS VARCHAR), 15, '0') AS card_pan,
    c.c_mktsegment AS card_type
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

PIPELINE = rf"""
dups AS (
  SELECT transaction_id FROM spend
  WHERE mcc IS NOT NULL AND transaction_id IS NOT NULL
  GROUP BY transaction_id HAVING count(*) > 1
),
ct AS (SELECT name, min(id) AS cardTypeId FROM card_types_dim WHERE tenant = '{T}' GROUP BY name),
ex AS (
  SELECT DISTINCT card_type_id AS ex_ct, mcc_mcc AS ex_mcc FROM exclusions_dim
  WHERE tenant = '{T}' AND card_type_id IS NOT NULL AND mcc_mcc IS NOT NULL
),
v0 AS (
  SELECT s.*, ct.cardTypeId,
    CASE WHEN regexp_matches(s.mcc, '^ *[+-]?[0-9]+ *$') THEN TRY_CAST(trim(s.mcc) AS INTEGER) END AS mcc_int,
    CASE WHEN regexp_matches(s.amount, '^ *[+-]?([0-9]+\.?[0-9]*|\.[0-9]+) *$')
         THEN TRY_CAST(trim(s.amount) AS DECIMAL(18,2)) END AS amount_num,
    {_RATE_CASE} AS rate,
    s.currency <> '{X.HOME_CURRENCY}' AS is_foreign,
    d.transaction_id IS NOT NULL AS dup
  FROM spend s
  LEFT JOIN dups d ON s.transaction_id = d.transaction_id
  LEFT JOIN ct ON s.card_type = ct.name
),
v1 AS (
  SELECT v0.*, ex.ex_ct IS NOT NULL AS excl_raw,
    CASE WHEN mcc IS NULL THEN {_q(X.R_MCC_EMPTY)}
         WHEN transaction_id IS NULL THEN {_q(X.R_TXID_EMPTY)}
         WHEN dup THEN {_q(X.R_DUPLICATE)}
         WHEN cardTypeId IS NULL THEN {_q(X.R_CARD_TYPE)}
         WHEN mcc_int IS NULL THEN {_q(X.R_ERROR + 'mcc')}
         WHEN currency IS NULL THEN {_q(X.R_ERROR + 'currency')} END AS before_reason
  FROM v0 LEFT JOIN ex ON v0.cardTypeId = ex.ex_ct AND v0.mcc_int = ex.ex_mcc
),
v AS (
  SELECT v1.*, excl_raw AND before_reason IS NULL AS excluded,
    COALESCE(before_reason, CASE WHEN NOT excl_raw THEN
      CASE WHEN rate IS NULL THEN currency || {_q(X.R_NOT_IN_RATES)}
           WHEN transaction_date IS NULL THEN {_q(X.R_ERROR + 'transaction_date')}
           WHEN NOT contains(transaction_date, '-') THEN {_q(X.R_DATE_SHAPE)} || transaction_date
           WHEN amount_num IS NULL THEN {_q(X.R_ERROR + 'amount')} END END) AS reason0
  FROM v1
),
rl AS (
  SELECT card_type_id AS r_ct,
    coalesce(title = 'base', FALSE) AS tb, coalesce(title = 'category', FALSE) AS tc,
    end_date IS NOT NULL AS tp, coalesce(is_foreign, FALSE) AS fo,
    coalesce(CAST(min_dollar_spent AS DECIMAL(24,6)), CAST(0 AS DECIMAL(24,6))) AS mn,
    upper(merchant) AS mu, custom_category_name AS cat, CAST(reward_rate AS DECIMAL(10,4)) AS rate
  FROM rules_dim
  WHERE is_active = TRUE AND card_type_id IS NOT NULL
    AND (coalesce(title = 'base', FALSE) OR coalesce(title = 'category', FALSE) OR end_date IS NOT NULL)
),
e0 AS (
  SELECT v.*, upper(merchant) AS mu, reason0 IS NULL AND NOT excluded AS ok,
    CASE WHEN reason0 IS NULL AND NOT excluded THEN
      CASE WHEN is_foreign
           THEN CAST(round_even(CAST(CAST(amount_num AS DECIMAL(24,6)) * rate AS DECIMAL(24,6)), 0) AS DECIMAL(24,6))
           ELSE CAST(CAST(amount_num AS DECIMAL(24,6)) * rate AS DECIMAL(24,6)) END END AS a0
  FROM v
),
{{tiers}}
fin AS (
  SELECT e3x.*, {_UNIT_CASE} AS unit,
    EXISTS (SELECT 1 FROM rl WHERE rl.r_ct = e3x.cardTypeId AND (rl.mu IS NOT NULL OR rl.cat IS NOT NULL)) AS needs_merchant
  FROM e3x
),
res AS (
  SELECT fin.*,
    COALESCE(reason0,
      CASE WHEN ok AND merchant IS NULL AND needs_merchant THEN {_q(X.R_ERROR + 'merchant')} END,
      CASE WHEN ok AND (r1 IS NOT NULL OR r2 IS NOT NULL OR r3 IS NOT NULL) AND unit IS NULL
           THEN {_q(X.R_ERROR + 'reward unit')} END) AS reject_reason
  FROM fin
),
out AS (
  SELECT res.*, a0 AS amount_sgd,
    reject_reason IS NULL AS accepted,
    CASE WHEN reject_reason IS NULL AND NOT excluded THEN r1 END AS rate_base,
    CASE WHEN reject_reason IS NULL AND NOT excluded THEN r2 END AS rate_cat,
    CASE WHEN reject_reason IS NULL AND NOT excluded THEN r3 END AS rate_camp,
    CASE WHEN reject_reason IS NOT NULL THEN NULL WHEN excluded THEN CAST(0 AS DECIMAL(24,6))
         WHEN r1 IS NOT NULL THEN a1 ELSE CAST(0 AS DECIMAL(24,6)) END AS rewardAmountBase,
    CASE WHEN reject_reason IS NOT NULL THEN NULL WHEN excluded THEN CAST(0 AS DECIMAL(24,6))
         WHEN r2 IS NOT NULL THEN a2 ELSE CAST(0 AS DECIMAL(24,6)) END AS rewardAmountCat,
    CASE WHEN reject_reason IS NOT NULL THEN NULL WHEN excluded THEN CAST(0 AS DECIMAL(24,6))
         WHEN r3 IS NOT NULL THEN a3 ELSE CAST(0 AS DECIMAL(24,6)) END AS rewardAmountCampaign,
    {{remarks}}
  FROM res
),
rem AS (
  SELECT out.*,
    CASE WHEN reject_reason IS NOT NULL THEN NULL
         WHEN excluded THEN {_q(X.EXCLUSION_REMARK)} || CAST(mcc_int AS VARCHAR)
         ELSE remark_base || ',' || remark_cat || ',' || remark_camp || ',' END AS remark
  FROM out
)"""


def _tier_sql() -> str:
    """e1..e3: best rate of each tier given the running amount of the one
    before; e1x..e3x: the running amount after it."""
    parts = []
    prev_tab, prev_a = "e0", "a0"
    for i, flag in enumerate(("tb", "tc", "tp"), start=1):
        parts.append(f"""e{i} AS (
  SELECT {prev_tab}.*,
    (SELECT max(r.rate) FROM rl r
      WHERE r.r_ct = {prev_tab}.cardTypeId AND r.{flag} AND r.rate > 0
        AND (NOT r.fo OR {prev_tab}.is_foreign)
        AND r.mn <= {prev_tab}.{prev_a}
        AND (r.mu IS NULL OR contains({prev_tab}.mu, r.mu))
        AND (r.cat IS NULL OR EXISTS (
              SELECT 1 FROM categories_dim c
              WHERE c.name IS NOT NULL AND c.mcc = {prev_tab}.mcc_int
                AND contains({prev_tab}.mu, upper(c.name)) AND c.merchant = r.cat))) AS r{i}
  FROM {prev_tab}
),
e{i}x AS (
  SELECT e{i}.*, CAST({prev_a} * coalesce(r{i}, CAST(1 AS DECIMAL(10,4))) AS DECIMAL(24,6)) AS a{i}
  FROM e{i}
),""")
        prev_tab, prev_a = f"e{i}x", f"a{i}"
    return "\n".join(parts)


def _remark_sql() -> str:
    cols = []
    for i, (lbl, name) in enumerate(zip(X.TIER_LABELS, ("remark_base", "remark_cat", "remark_camp")),
                                    start=1):
        rate_txt = (f"CAST(CAST(round(CASE WHEN cardTypeId = {X.PERCENT_CARD_TYPE_ID} THEN r{i} * 100 "
                    f"ELSE r{i} END, 2) AS DOUBLE) AS VARCHAR)")
        text = f"{_q(lbl + ' giving ')} || {rate_txt} || ' ' || unit || '/SGD'"
        cols.append(f"CASE WHEN reject_reason IS NOT NULL OR excluded THEN NULL "
                    f"WHEN r{i} IS NOT NULL THEN {text} ELSE '' END AS {name}")
    return ",\n    ".join(cols)


def _pipeline() -> str:
    return PIPELINE.replace("{tiers}", _tier_sql()).replace("{remarks}", _remark_sql())


def _dims_sql() -> str:
    return ",\n".join(f"{k} AS ({v})" for k, v in DIMS.items())


def spend_sql(select: str) -> str:
    return f"WITH {_dims_sql()},\n{SPEND},\n{_pipeline()}\n{select}"


USERS = rf"""
users AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS id,
    split_part(c.c_name, '#', 1) AS first_name,
    CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE split_part(c.c_name, '#', 2) END AS last_name,
    'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
    '+65' || lpad(CAST(c.c_custkey AS VARCHAR), 8, '0') AS phone,
    'card-' || CAST(c.c_custkey AS VARCHAR) || '-' || CAST(o.o_orderkey % 6 AS VARCHAR) AS card_id,
    '5' || lpad(CAST(c.c_custkey AS VARCHAR), 14, '0') || CAST(o.o_orderkey % 6 AS VARCHAR) AS card_pan,
    CASE o.o_orderkey % 6 WHEN 0 THEN 'scis_shopping' WHEN 1 THEN 'scis_freedom'
      WHEN 2 THEN 'scis_platinummiles' WHEN 3 THEN 'scis_premiummiles' WHEN 4 THEN 'scis_student' END AS card_type,
    strftime(o.o_orderdate, '%Y-%m-%d') AS created_at
  FROM customer c JOIN orders o ON c.c_custkey = o.o_custkey
),
prep AS (
  SELECT id, email, phone, card_id, card_type, first_name || ' ' || last_name AS name, created_at,
    '{T}' AS TENANT, {_REWARD_TYPE_CASE} AS REWARD_TYPE
  FROM users
),
dd_customer AS (
  SELECT id, email, TENANT FROM (
    SELECT *, row_number() OVER (PARTITION BY id, TENANT ORDER BY email NULLS LAST) AS rn FROM prep)
  WHERE rn = 1
),
dd_card AS (
  SELECT card_id, card_type, REWARD_TYPE, TENANT, id FROM (
    SELECT *, row_number() OVER (PARTITION BY card_id, TENANT
      ORDER BY card_type NULLS LAST, REWARD_TYPE NULLS LAST, id NULLS LAST) AS rn FROM prep)
  WHERE rn = 1
),
dd_cardtype AS (SELECT DISTINCT card_type, TENANT FROM prep),
dd_campaign AS (
  SELECT email, name, phone, card_type, TENANT FROM (
    SELECT *, row_number() OVER (PARTITION BY name, card_type
      ORDER BY email NULLS LAST, phone NULLS LAST, TENANT NULLS LAST) AS rn FROM prep)
  WHERE rn = 1
),
tgt_customer AS (
  SELECT CASE WHEN c_nationkey < 10 THEN CAST(c_custkey AS VARCHAR) ELSE 'x-' || CAST(c_custkey AS VARCHAR) END AS customer_id,
    'old' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, t.tenant
  FROM customer CROSS JOIN (VALUES ('{T}'), ('other')) AS t(tenant)
),
tgt_card AS (
  SELECT CASE WHEN c_nationkey < 10 THEN 'card-' || CAST(c_custkey AS VARCHAR) || '-0' ELSE 'x-' || 'card-' || CAST(c_custkey AS VARCHAR) || '-0' END AS card_id, 'scis_shopping' AS card_type,
    'cashback' AS reward_type, '{T}' AS tenant, CAST(c_custkey AS VARCHAR) AS customer_id
  FROM customer
),
tgt_campaign AS (
  SELECT 'old' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email, CASE WHEN c_nationkey < 10 THEN replace(c_name, '#', ' ') ELSE 'x-' || replace(c_name, '#', ' ') END AS name,
    '+6500000000' AS phone_number, CAST(1 AS INTEGER) AS card_type_id
  FROM customer
),
ct_src AS (SELECT card_type AS name, TENANT AS tenant FROM dd_cardtype WHERE card_type IS NOT NULL),
ct_new AS (
  SELECT s.name, s.tenant FROM ct_src s
  WHERE NOT EXISTS (SELECT 1 FROM campaign_card_types_dim t WHERE t.name = s.name AND t.tenant = s.tenant)
),
ct_all AS (
  SELECT CAST(id AS BIGINT) AS id, name, tenant FROM campaign_card_types_dim
  UNION ALL
  SELECT (SELECT coalesce(max(id), 0) FROM campaign_card_types_dim)
         + row_number() OVER (ORDER BY name NULLS FIRST, tenant NULLS FIRST), name, tenant FROM ct_new
),
ct_key AS (SELECT name, tenant, min(id) AS card_type_id FROM ct_all GROUP BY name, tenant),
cc_resolved AS (
  SELECT d.email, d.name, d.phone AS phone_number, d.card_type, k.card_type_id
  FROM dd_campaign d LEFT JOIN ct_key k ON d.card_type = k.name AND d.TENANT = k.tenant
)"""


def users_sql(select: str) -> str:
    return f"WITH {_dims_sql()},\n{USERS}\n{select}"


def _merge(target: str, source: str, cols: list[str], keys: list[str], update: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    sel = []
    for c in cols:
        if c in update:
            sel.append(f"CASE WHEN s.s_hit THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            sel.append(f"CASE WHEN t.t_hit THEN t.{c} ELSE s.{c} END AS {c}")
    return (f"SELECT {', '.join(sel)} FROM (SELECT *, TRUE AS t_hit FROM {target}) t "
            f"FULL OUTER JOIN (SELECT *, TRUE AS s_hit FROM {source}) s ON {on}")


_ACC = "FROM rem WHERE reject_reason IS NULL"

QUERIES = {
    "reject_missing_mcc": spend_sql(
        f"SELECT id, transaction_id, card_type, reject_reason FROM rem WHERE reject_reason = {_q(X.R_MCC_EMPTY)}"),
    "reject_duplicates": spend_sql(
        f"SELECT id, transaction_id, card_type, reject_reason FROM rem WHERE reject_reason = {_q(X.R_DUPLICATE)}"),
    "reject_unregistered_card": spend_sql(
        f"SELECT id, transaction_id, card_type, reject_reason FROM rem WHERE reject_reason = {_q(X.R_CARD_TYPE)}"),
    "reject_reasons": spend_sql("SELECT id, transaction_id, reject_reason FROM rem"),
    "convert_currency": spend_sql(
        "SELECT id, currency, rate, is_foreign, amount_sgd FROM rem WHERE amount_sgd IS NOT NULL"),
    "mcc_exclusion": spend_sql(
        f"SELECT id, transaction_id, cardTypeId AS card_type_id, mcc_int AS mcc, remark {_ACC} AND excluded"),
    "merchant_categories": spend_sql(
        "SELECT r.transaction_id, r.merchant, r.mcc_int AS mcc, c.name AS pattern, c.merchant AS category "
        "FROM rem r JOIN categories_dim c ON c.mcc = r.mcc_int AND c.name IS NOT NULL "
        "AND contains(upper(r.merchant), upper(c.name)) "
        "WHERE r.reject_reason IS NULL AND NOT r.excluded"),
    "base_reward": spend_sql(
        f"SELECT transaction_id, cardTypeId AS card_type_id, amount_sgd, rate_base, rewardAmountBase "
        f"{_ACC} AND NOT excluded"),
    "tiered_rewards": spend_sql(
        f"SELECT transaction_id, rate_base, rate_cat, rate_camp, rewardAmountBase, rewardAmountCat, "
        f"rewardAmountCampaign {_ACC}"),
    "reward_remarks": spend_sql(
        f"SELECT transaction_id, remark_base, remark_cat, remark_camp, remark {_ACC}"),
    "reward_messages": spend_sql(rf"""
, msg AS (
  SELECT *, 'base' AS tier, CAST(0 AS DECIMAL(24,6)) AS reward, remark AS remarks FROM rem
    WHERE reject_reason IS NULL AND amount_num IS NOT NULL AND excluded
  UNION ALL
  SELECT *, 'base', rewardAmountBase, remark_base FROM rem
    WHERE reject_reason IS NULL AND amount_num IS NOT NULL AND NOT excluded AND remark_base <> ''
  UNION ALL
  SELECT *, 'category', rewardAmountCat, remark_cat FROM rem
    WHERE reject_reason IS NULL AND amount_num IS NOT NULL AND NOT excluded AND remark_cat <> ''
  UNION ALL
  SELECT *, 'campaign', rewardAmountCampaign, remark_camp FROM rem
    WHERE reject_reason IS NULL AND amount_num IS NOT NULL AND NOT excluded AND remark_camp <> ''
)
SELECT upper('{T}') AS tenant, transaction_id AS transactionId, transaction_date AS transactionDate,
  card_id AS cardId, merchant, mcc_int AS mcc, currency, CAST(amount_num AS DECIMAL(28,10)) AS amount,
  CAST(round(reward, 2) AS DECIMAL(18,2)) AS rewardAmount, remarks, tier,
  sha256(upper('{T}') || '|' || transaction_id || '|' || tier) AS messageKey
FROM msg"""),
    "run_report": spend_sql(
        f"SELECT '{tv.REPORT_FILE}' AS filename, count(*) AS numberOfRows, "
        "count(*) FILTER (WHERE reject_reason IS NULL) AS numberOfProcessed, "
        "count(*) FILTER (WHERE reject_reason IS NOT NULL) AS numberOfRejected, "
        f"CASE WHEN count(*) FILTER (WHERE reject_reason IS NOT NULL) > 0 THEN '{tv.REPORT_ERROR_PATH}' ELSE '' END "
        "AS errorFileURL FROM rem"),
    "reject_file": spend_sql(
        "SELECT id, transaction_id, merchant, mcc, currency, amount, transaction_date, card_id, "
        "CASE WHEN card_pan IS NULL THEN NULL ELSE '****' || right(card_pan, 4) END AS card_pan, "
        "card_type, reject_reason FROM rem WHERE reject_reason IS NOT NULL"),
    "rewards_by_card_type": spend_sql(
        "SELECT card_type, count(*) AS accepted, count(*) FILTER (WHERE excluded) AS excluded, "
        "CAST(sum(amount_sgd) AS DECIMAL(24,6)) AS amount_sgd, "
        "CAST(sum(rewardAmountBase) AS DECIMAL(24,6)) AS reward_base, "
        "CAST(sum(rewardAmountCat) AS DECIMAL(24,6)) AS reward_cat, "
        f"CAST(sum(rewardAmountCampaign) AS DECIMAL(24,6)) AS reward_campaign {_ACC} GROUP BY card_type"),
    "normalise_dates": f"WITH {SPEND}\n" + r"""
SELECT id, transaction_date,
  CASE WHEN contains(transaction_date, '/') AND len(string_split(transaction_date, '/')) = 3 THEN
    concat_ws('-', string_split(transaction_date, '/')[1],
      CASE WHEN length(string_split(transaction_date, '/')[2]) = 1 THEN '0' || string_split(transaction_date, '/')[2]
           ELSE string_split(transaction_date, '/')[2] END,
      CASE WHEN length(string_split(transaction_date, '/')[3]) = 1 THEN '0' || string_split(transaction_date, '/')[3]
           ELSE string_split(transaction_date, '/')[3] END)
  ELSE transaction_date END AS normalised_date
FROM spend""",
    "reject_folder": r"""
WITH k AS (
  SELECT 'uploads/' || strftime(o_orderdate, '%Y%m') || '/users-' || CAST(o_orderkey AS VARCHAR) || '.csv' AS object_key
  FROM orders)
SELECT object_key, string_split(object_key, '/')[-1] AS file_name,
  'error/' || string_split(object_key, '/')[-2] || '/' AS reject_folder FROM k""",
    "user_names_reward_type": users_sql(
        "SELECT id, email, phone, card_id, card_type, name, TENANT, REWARD_TYPE FROM prep"),
    "users_dedupe_customer": users_sql("SELECT * FROM dd_customer"),
    "users_dedupe_card": users_sql("SELECT * FROM dd_card"),
    "users_dedupe_cardtype": users_sql("SELECT * FROM dd_cardtype"),
    "users_dedupe_campaign": users_sql("SELECT * FROM dd_campaign"),
    "upsert_customer": users_sql(
        ", src AS (SELECT id AS customer_id, email, TENANT AS tenant FROM dd_customer "
        "WHERE id IS NOT NULL AND TENANT IS NOT NULL)\n"
        + _merge("tgt_customer", "src", ["customer_id", "email", "tenant"],
                 ["customer_id", "tenant"], ["email"])),
    "upsert_card": users_sql(
        ", src AS (SELECT card_id, card_type, REWARD_TYPE AS reward_type, TENANT AS tenant, "
        "id AS customer_id FROM dd_card WHERE card_id IS NOT NULL AND TENANT IS NOT NULL)\n"
        + _merge("tgt_card", "src", ["card_id", "card_type", "reward_type", "tenant", "customer_id"],
                 ["card_id", "tenant"], ["card_type", "reward_type", "customer_id"])),
    "insert_new_card_types": users_sql("SELECT id, name, tenant FROM ct_all"),
    "resolve_card_type_fk": users_sql(
        "SELECT email, name, phone_number, card_type_id, "
        f"CASE WHEN card_type_id IS NULL THEN {_q(X.R_NO_CARD_TYPE_ID)} END AS reject_reason "
        "FROM cc_resolved"),
    "upsert_campaign_customer": users_sql(
        ", src AS (SELECT email, name, phone_number, card_type_id FROM cc_resolved "
        "WHERE card_type_id IS NOT NULL AND name IS NOT NULL),\n"
        "tgt AS (SELECT email, name, phone_number, CAST(card_type_id AS BIGINT) AS card_type_id "
        "FROM tgt_campaign)\n"
        + _merge("tgt", "src", ["email", "name", "phone_number", "card_type_id"],
                 ["card_type_id", "name"], ["email", "phone_number"])),
    "user_rejects": users_sql(r"""
, r AS (
  SELECT 'card_customer' AS table_name, CASE WHEN id IS NULL THEN 'customer_id' ELSE 'tenant' END || ' is empty!' AS reject_reason,
    id AS customer_id, email, NULL AS name, NULL AS phone_number, NULL AS card_id, NULL AS card_type,
    NULL AS card_type_id, NULL AS reward_type, TENANT AS tenant
  FROM dd_customer WHERE id IS NULL OR TENANT IS NULL
  UNION ALL
  SELECT 'card', CASE WHEN card_id IS NULL THEN 'card_id' ELSE 'tenant' END || ' is empty!',
    id, NULL, NULL, NULL, card_id, card_type, NULL, REWARD_TYPE, TENANT
  FROM dd_card WHERE card_id IS NULL OR TENANT IS NULL
  UNION ALL
  SELECT 'card_type', CASE WHEN card_type IS NULL THEN 'name' ELSE 'tenant' END || ' is empty!',
    NULL, NULL, NULL, NULL, NULL, card_type, NULL, NULL, TENANT
  FROM dd_cardtype WHERE card_type IS NULL OR TENANT IS NULL
  UNION ALL
  SELECT 'campaign_customer', """ + _q(X.R_NO_CARD_TYPE_ID) + r""",
    NULL, email, name, phone_number, NULL, card_type, NULL, NULL, '""" + T + r"""'
  FROM cc_resolved WHERE card_type_id IS NULL
  UNION ALL
  SELECT 'campaign_customer', 'name is empty!',
    NULL, email, name, phone_number, NULL, card_type, CAST(card_type_id AS VARCHAR), NULL, '""" + T + r"""'
  FROM cc_resolved WHERE card_type_id IS NOT NULL AND name IS NULL
)
SELECT table_name, reject_reason, * EXCLUDE (table_name, reject_reason) FROM r"""),
    "assign_ids": users_sql(
        f"SELECT email, name, phone, card_type, TENANT, CAST({tv.ID_START} AS BIGINT) "
        f"+ row_number() OVER (ORDER BY card_type NULLS FIRST, name NULLS FIRST) AS customer_id "
        f"FROM dd_campaign WHERE card_type IS NOT NULL AND name IS NOT NULL"),
}
# written without the engine's decimal types: amounts and rates as scaled integers
QUERIES["convert_small_rates"] = f"""WITH {SPEND},
k AS (SELECT id, CAST(round(TRY_CAST(amount AS DOUBLE) * 100) AS HUGEINT) AS cents, CAST(card_id AS BIGINT) % 5 AS c
      FROM spend),
m AS (SELECT id, cents, (['IDR', 'VND', 'JPY', 'XXX', 'SGD'])[c + 1] AS currency,
             ([85, 40, 9100, 0, 1000000])[c + 1] AS millionths FROM k),
p AS (SELECT *, CAST(cents AS HUGEINT) * millionths AS e8 FROM m)
SELECT id, currency, CASE WHEN millionths = 0 THEN currency || ' is not in currency mapping!'
                          WHEN cents IS NULL THEN 'Error in processing: amount' END AS reject_reason,
  CASE WHEN millionths = 0 THEN NULL
       WHEN currency = 'SGD' THEN CAST(cents AS DOUBLE) / 100
       ELSE CAST(e8 // 100000000 + CASE WHEN e8 % 100000000 > 50000000
              OR (e8 % 100000000 = 50000000 AND (e8 // 100000000) % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)
  END AS amount_sgd
FROM p"""
QUERIES["amount_precision"] = f"""WITH {SPEND},
k AS (SELECT id, amount AS a, CAST(card_id AS BIGINT) % 5 AS c FROM spend)
SELECT id, CASE c WHEN 0 THEN a || '55' WHEN 1 THEN a || 'e3' WHEN 2 THEN '99999999999' || a
                  WHEN 3 THEN '9999999999999999999' || a ELSE a || 'E-2' END AS amount,
  CASE WHEN a = 'n/a' OR c = 3 OR (c = 2 AND length(split_part(a, '.', 1)) > 7) THEN 'Error in processing: amount'
  END AS reject_reason,
  CASE WHEN a = 'n/a' THEN NULL ELSE
  CASE c WHEN 0 THEN TRY_CAST(a || '55' AS DOUBLE)
         WHEN 1 THEN CAST(TRY_CAST(replace(a, '.', '') AS HUGEINT) * 10 AS DOUBLE)
         WHEN 2 THEN CASE WHEN length(split_part(a, '.', 1)) <= 7 THEN TRY_CAST('99999999999' || a AS DOUBLE) END
         WHEN 4 THEN TRY_CAST(replace(a, '.', '') AS DOUBLE) / 10000 END END AS amount_sgd
FROM k"""
QUERIES["merchant_patterns"] = f"""WITH {SPEND},
r AS (SELECT id, merchant || ' store ' || split_part(id, '-', 3) AS merchant, TRY_CAST(mcc AS INTEGER) AS mcc
      FROM spend),
t AS (SELECT p_partkey AS k, p_name || ' store ' || p_partkey AS t, p_size, p_type FROM part),
p AS (SELECT CASE WHEN k % 307 = 0 THEN NULL WHEN k % 3 = 0 THEN upper(q) ELSE q END AS pattern, p_size AS mcc,
             p_type AS category
      FROM (SELECT *, CASE WHEN k % 211 = 0 THEN substr(t, 1, 2) ELSE substr(t, k % 7 + 1, k % 13 + 5) END AS q FROM t))
SELECT r.id, r.merchant, r.mcc, p.pattern, p.category
FROM r JOIN p ON r.mcc = p.mcc AND contains(upper(r.merchant), upper(p.pattern))"""
QUERIES["reject_duplicates_slots"] = QUERIES["reject_duplicates"]
QUERIES["convert_currency_rate_table"] = QUERIES["convert_currency"]
QUERIES["merge_bucketed_customer"] = QUERIES["upsert_customer"]
QUERIES["message_body"] = (
    "SELECT messageKey, tenant, transactionId, transactionDate, cardId, merchant, mcc, currency, "
    "CAST(amount AS DOUBLE) AS amount, CAST(rewardAmount AS DOUBLE) AS rewardAmount, remarks FROM (\n"
    + QUERIES["reward_messages"] + "\n) AS m")
QUERIES["csv_by_header_name"] = f"WITH {SPEND}\nSELECT * FROM spend"
_LINE = "concat_ws(',', " + ", ".join(f"coalesce({c}, '')" for c in S.SPEND_COLUMNS) + ")"
QUERIES["csv_bad_lines"] = f"""WITH {SPEND},
k AS (SELECT id, CAST(split_part(id, '-', 3) AS BIGINT) % 50 AS k, {_LINE} AS line FROM spend)
SELECT CASE WHEN k NOT IN (7, 8) THEN id END AS id,
       CASE k WHEN 7 THEN regexp_replace(line, ',[^,]*$', '') WHEN 8 THEN line || ',more' END AS line,
       CASE WHEN k IN (7, 8) THEN 'Malformed line' END AS reject_reason
FROM k"""
QUERIES["message_stream"] = QUERIES["reward_messages"]
QUERIES["run_report_observed"] = QUERIES["run_report"]
_LINE_RULES = """SELECT CASE l_linenumber % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'category' ELSE 'campaign' END AS title,
    CAST(l_suppkey % 4 + 1 AS INTEGER) AS card_type_id,
    CASE WHEN l_linenumber % 3 = 2 THEN DATE '2025-12-31' END AS end_date, TRUE AS is_active,
    CASE WHEN l_partkey % 5 = 0 THEN TRUE END AS is_foreign,
    CAST(floor(l_extendedprice) AS DECIMAL(18,2)) AS min_dollar_spent,
    CASE l_partkey % 4 WHEN 0 THEN 'ring' WHEN 1 THEN 'Blue' END AS merchant,
    CASE WHEN l_partkey % 11 = 0 THEN 'tools' END AS custom_category_name,
    CAST(((l_orderkey * 7 + l_partkey) % 4000 + 100) * 0.0001 AS DECIMAL(10,4)) AS reward_rate FROM lineitem"""
QUERIES["tiered_rewards_many_rules"] = QUERIES["tiered_rewards"].replace(DIMS["rules_dim"], _LINE_RULES)
QUERIES["users_dedupe_latest"] = users_sql("""
SELECT id, email, TENANT FROM (
  SELECT *, row_number() OVER (PARTITION BY id, TENANT
    ORDER BY created_at DESC NULLS LAST, email DESC NULLS LAST) AS rn
  FROM (SELECT * REPLACE (CASE WHEN card_type IS NULL THEN NULL ELSE email || '.' || created_at END AS email) FROM prep))
WHERE rn = 1""")
QUERIES["tiered_rewards_join"] = QUERIES["tiered_rewards"]
QUERIES["file_stream_spend"] = QUERIES["reject_reasons"]
QUERIES["file_stream_users"] = QUERIES["upsert_campaign_customer"]


# decimal columns of each query, returned as DOUBLE (see registry._as_doubles)
_DOUBLES = {
    "convert_currency": ["rate", "amount_sgd"],
    "base_reward": ["amount_sgd", "rate_base", "rewardAmountBase"],
    "tiered_rewards": ["rate_base", "rate_cat", "rate_camp", "rewardAmountBase", "rewardAmountCat",
                       "rewardAmountCampaign"],
    "reward_messages": ["amount", "rewardAmount"],
    "rewards_by_card_type": ["amount_sgd", "reward_base", "reward_cat", "reward_campaign"],
}
_DOUBLES["tiered_rewards_join"] = _DOUBLES["tiered_rewards"]
_DOUBLES["tiered_rewards_many_rules"] = _DOUBLES["tiered_rewards"]
_DOUBLES["message_stream"] = _DOUBLES["reward_messages"]
_DOUBLES["convert_currency_rate_table"] = _DOUBLES["convert_currency"]
for _name, _cols in _DOUBLES.items():
    _repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _cols)
    QUERIES[_name] = f"SELECT * REPLACE ({_repl}) FROM (\n{QUERIES[_name]}\n) AS q"
