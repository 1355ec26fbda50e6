"""Adapters from the generated TPC-H-style tables to spend and user files.

The spend file is one row per lineitem and the user file one row per order,
so both grow with the tables. Every derived field is a plain expression that
reads the same in Spark and in DuckDB (see ``rewardflow.plans.oracle``).
The rule, exclusion, category and card-type dimensions are small literal
tables shared by both sides.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.joins import DEFAULT_MAX_BROADCAST_ROWS, small_side
from ..operators.partitioning import spread
from ..operators.validate import may_crowd

TENANT = "acme"
REPORT_FILE = "spend.csv"          # file name shown in the test run report
REPORT_ERROR_PATH = "error/run-1/"  # reject folder shown in the test run report
ID_START = 1000                     # ids given by the test id query start after this


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# ---------------------------------------------------------------- facts
def spend(spark: SparkSession, sf_dir: str, order: str | None = None) -> DataFrame:
    """Card-spend rows (all text), one per lineitem.

    transaction_id repeats wherever (l_orderkey, l_linenumber) repeats, so
    real duplicates exist. Some rows carry NULL or malformed fields so that
    every reject branch is exercised on the whole table.
    """
    return spend_from_lineitems(spark, sf_dir, spread(table(spark, sf_dir, "lineitem")), order)


def spend_from_lineitems(spark: SparkSession, sf_dir: str, lineitems: DataFrame,
                         order: str | None = None) -> DataFrame:
    """The spend adapter over any set of lineitem rows (a table or a
    micro-batch); extra columns of ``lineitems`` such as ``source_file`` are
    carried through. ``order``: a column of that name with the order of each row, which
    rows with equal transaction ids have in common (the id begins with it)."""
    extra = [c for c in lineitems.columns if c == "source_file"]
    # a date and one small number instead of the time stamp and the supplier, as the rows are shuffled for the joins
    sk10, sk17 = F.col("l_suppkey") % 10, F.col("l_suppkey") % 17
    money = F.when(sk10 < 6, 0).when(sk10 < 8, 1).when(sk10 == 8, 2).otherwise(3)
    kind = (money + F.when(sk17 == 0, 4).otherwise(0)).cast("tinyint")
    li = lineitems.where("l_orderkey is not null and l_partkey is not null").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", F.col("l_shipdate").cast("date").alias("ship"),
        kind.alias("kind"), *extra)
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    few = _few_orders(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    # the customers go to the orders first, so the line items are not shuffled for them; the orders
    # come last, so the rows of a large join lie by order, as the duplicate check wants them
    o = o.join(c, F.col("o_custkey") == F.col("c_custkey"))
    j = (li.join(p, F.col("l_partkey") == F.col("p_partkey"))
           .join(small_side(o, bounded=few), li.l_orderkey == o.o_orderkey))
    pk, money = F.col("l_partkey"), F.col("kind") % 4
    size = F.col("p_size")
    ship = F.col("ship")
    return j.select(
        F.concat_ws("-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber")), _s(pk)).alias("id"),
        F.when(pk % 97 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("-", _s(F.col("l_orderkey")), _s(F.col("l_linenumber"))))
         .alias("transaction_id"),
        F.when(pk % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("p_name")).alias("merchant"),
        F.when(size == 50, F.lit(None).cast("string")).when(size == 49, F.lit("x"))
         .otherwise(_s(size)).alias("mcc"),
        F.when(pk % 103 == 0, F.lit(None).cast("string"))
         .when(money == 0, F.lit("SGD")).when(money == 1, F.lit("USD"))
         .when(money == 2, F.lit("sgd")).otherwise(F.lit("EUR")).alias("currency"),
        F.when(pk % 89 == 0, F.lit("n/a"))
         .otherwise(_s(F.col("l_extendedprice").cast("decimal(18,2)"))).alias("amount"),
        F.when(F.col("kind") >= 4, F.date_format(ship, "d/M/yyyy"))
         .otherwise(F.date_format(ship, "yyyy-MM-dd")).alias("transaction_date"),
        _s(F.col("o_custkey")).alias("card_id"),
        F.concat(F.lit("4"), F.lpad(_s(F.col("o_custkey")), 15, "0")).alias("card_pan"),
        F.col("c_mktsegment").alias("card_type"),
        *[F.col(c) for c in extra],
        *([F.col("l_orderkey").alias(order)] if order else []),
    )


def _few_orders(spark: SparkSession, sf_dir: str) -> bool:
    return table(spark, sf_dir, "orders").count() <= DEFAULT_MAX_BROADCAST_ROWS


def lie_by_order(spark: SparkSession, sf_dir: str) -> bool:
    """Whether the spend rows lie by their order after the joins (the orders are too many to be
    broadcast) and no order has so many that they should not meet in one task."""
    if _few_orders(spark, sf_dir):
        return False
    return not may_crowd(table(spark, sf_dir, "lineitem").where("l_orderkey is not null"), ["l_orderkey"])


def part_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A category table that grows with the parts: pieces of the merchant texts that the
    parts' spend rows have, some of two characters, some upper-cased, some NULL."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = F.concat(F.col("p_name"), F.lit(" store "), _s(k))
    piece = (F.when(k % 211 == 0, F.substring(text, 1, 2))
             .otherwise(F.substr(text, (k % 7 + 1).cast("int"), (k % 13 + 5).cast("int"))))
    return p.select(F.when(k % 307 == 0, F.lit(None).cast("string")).when(k % 3 == 0, F.upper(piece))
                    .otherwise(piece).alias("name"),
                    F.col("p_size").cast("int").alias("mcc"), F.col("p_type").alias("merchant"))


def lineitem_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule table that grows with the line items: one rule each, of any tier, minimum
    and rate, some for foreign spend, a merchant or a category only."""
    li = spread(table(spark, sf_dir, "lineitem"))
    pk, kind = F.col("l_partkey"), F.col("l_linenumber") % 3
    points = (F.col("l_orderkey") * 7 + pk) % 4000 + 100
    return li.select(
        F.when(kind == 0, "base").when(kind == 1, "category").otherwise("campaign").alias("title"),
        (F.col("l_suppkey") % 4 + 1).cast("int").alias("card_type_id"),
        F.when(kind == 2, F.lit(_dt.date(2025, 12, 31))).alias("end_date"),
        F.lit(True).alias("is_active"),
        F.when(pk % 5 == 0, F.lit(True)).alias("is_foreign"),
        F.floor("l_extendedprice").cast("decimal(18,2)").alias("min_dollar_spent"),
        F.when(pk % 4 == 0, "ring").when(pk % 4 == 1, "Blue").alias("merchant"),
        F.when(pk % 11 == 0, "tools").alias("custom_category_name"),
        (points.cast("decimal(10,0)") * F.lit(D("0.0001"))).cast("decimal(10,4)").alias("reward_rate"))


def _card_kind(orderkey: Column) -> Column:
    k = orderkey % 6
    return (F.when(k == 0, "scis_shopping").when(k == 1, "scis_freedom")
             .when(k == 2, "scis_platinummiles").when(k == 3, "scis_premiummiles")
             .when(k == 4, "scis_student"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User rows (all text), one per order: a customer appears once per order
    and a card once per order of its kind, so every dedupe has work."""
    return users_from_orders(spark, sf_dir, spread(table(spark, sf_dir, "orders")))


def users_from_orders(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """The user adapter over any set of order rows (a table or a micro-batch)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = c.join(o, F.col("c_custkey") == F.col("o_custkey"))
    ck = F.col("c_custkey")
    parts = F.split(F.col("c_name"), "#")
    kind = F.col("o_orderkey") % 6
    return j.select(
        _s(ck).alias("id"),
        F.try_element_at(parts, F.lit(1)).alias("first_name"),
        F.when(ck % 13 == 0, F.lit(None).cast("string")).otherwise(F.try_element_at(parts, F.lit(2))).alias("last_name"),
        F.concat(F.lit("user"), _s(ck), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+65"), F.lpad(_s(ck), 8, "0")).alias("phone"),
        F.concat(F.lit("card-"), _s(ck), F.lit("-"), _s(kind)).alias("card_id"),
        F.concat(F.lit("5"), F.lpad(_s(ck), 14, "0"), _s(kind)).alias("card_pan"),
        _card_kind(F.col("o_orderkey")).alias("card_type"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("created_at"),
    )


# ------------------------------------------------- existing target tables
def card_customers_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-DB customers already loaded: every customer with an old e-mail (under a
    key that no user row has, from nation 10 on), plus the same keys under another
    tenant (must stay untouched)."""
    c = table(spark, sf_dir, "customer")
    ck = _s(F.col("c_custkey"))
    old = F.concat(F.lit("old"), ck, F.lit("@example.com"))
    a = c.select(_loaded(ck).alias("customer_id"), old.alias("email"), F.lit(TENANT).alias("tenant"))
    b = c.select(_loaded(ck).alias("customer_id"), old.alias("email"), F.lit("other").alias("tenant"))
    return a.unionByName(b)


def _loaded(key: Column) -> Column:
    return F.when(F.col("c_nationkey") < 10, key).otherwise(F.concat(F.lit("x-"), key))


def cards_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ck = _s(F.col("c_custkey"))
    return c.select(
        _loaded(F.concat(F.lit("card-"), ck, F.lit("-0"))).alias("card_id"),
        F.lit("scis_shopping").alias("card_type"),
        F.lit("cashback").alias("reward_type"),
        F.lit(TENANT).alias("tenant"),
        ck.alias("customer_id"),
    )


def campaign_customers_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ck = _s(F.col("c_custkey"))
    return c.select(
        F.concat(F.lit("old"), ck, F.lit("@example.com")).alias("email"),
        _loaded(F.regexp_replace(F.col("c_name"), "#", " ")).alias("name"),
        F.lit("+6500000000").alias("phone_number"),
        F.lit(1).cast("int").alias("card_type_id"),
    )


# ------------------------------------------------------ literal dimensions
D = Decimal
CARD_TYPES = [
    (1, "AUTOMOBILE", TENANT), (2, "BUILDING", TENANT), (3, "FURNITURE", TENANT),
    (4, "HOUSEHOLD", TENANT), (5, "MACHINERY", "other"), (6, "AUTOMOBILE", "other"),
]

EXCLUSIONS = [
    (1, 13, TENANT), (3, 7, TENANT), (4, 1, TENANT), (1, 13, TENANT), (2, 21, "other"),
]

# title, card_type_id, end_date, is_active, is_foreign, min_dollar_spent, merchant,
# custom_category_name, reward_rate
RULES = [
    ("base", 1, None, True, None, None, None, None, D("0.0100")),
    ("base", 1, None, True, True, None, None, None, D("0.0150")),
    ("category", 1, None, True, None, None, None, "jewellery", D("0.0500")),
    ("category", 1, None, True, None, D("300.00"), "widget", None, D("0.0300")),
    ("campaign", 1, _dt.date(2025, 12, 31), True, None, None, "blue", None, D("2.0000")),
    ("base", 2, None, True, None, None, None, None, D("1.5000")),
    ("base", 2, _dt.date(2024, 6, 30), True, True, None, None, None, D("3.0000")),
    ("category", 2, None, True, None, None, "RING", None, D("2.0000")),
    ("base", 3, None, True, None, None, None, None, D("2.0000")),
    ("category", 3, None, True, None, D("1000.00"), None, "colour", D("3.0000")),
    ("campaign", 3, _dt.date(2023, 1, 1), True, False, None, "", None, D("1.2500")),
    ("base", 4, None, True, None, None, None, None, D("1.0000")),
    ("category", 4, None, True, None, None, "green", None, D("0.0000")),
    ("category", 4, None, True, None, None, "bolt", None, D("-1.0000")),
    ("campaign", 4, _dt.date(2022, 1, 1), False, None, None, None, None, D("9.0000")),
    ("category", 4, None, None, None, None, None, "tools", D("2.5000")),
    ("category", 4, None, True, None, D("50000.00"), "ring", None, D("1.5000")),
    ("promo", 4, None, True, None, None, None, None, D("7.0000")),
    ("category", 4, None, True, None, None, "small", "tools", D("1.7500")),
    ("base", 5, None, True, None, None, None, None, D("1.0000")),
]

# name (merchant pattern), mcc, merchant (category label)
CATEGORIES = [
    ("ring", 5, "jewellery"), ("RING", 6, "jewellery"), ("blue", 12, "colour"),
    ("red", 12, "colour"), ("widget", 20, "tools"), ("small", 20, "tools"),
    ("bolt", 33, "tools"), ("green", 5, "colour"), ("ring", 40, "jewellery"),
    ("hot", 40, "colour"),
]

# campaign-DB card types already present
CAMPAIGN_CARD_TYPES = [
    (1, "scis_shopping", TENANT), (2, "scis_freedom", TENANT),
    (3, "scis_platinummiles", "other"), (5, "scis_gold", TENANT),
]


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, Decimal):
        return f"{v}BD"
    if isinstance(v, _dt.date):
        return f"DATE'{v.isoformat()}'"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def local_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A small literal table held on the driver (an inline VALUES relation),
    typed by ``schema``."""
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_lit(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})").to(schema)


def card_types(spark: SparkSession) -> DataFrame:
    return local_table(spark, CARD_TYPES, S.CARD_TYPE_SCHEMA)


def exclusions(spark: SparkSession) -> DataFrame:
    return local_table(spark, EXCLUSIONS, S.EXCLUSION_SCHEMA)


def rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, RULES, S.RULE_SCHEMA)


def categories(spark: SparkSession) -> DataFrame:
    return local_table(spark, CATEGORIES, S.CATEGORY_SCHEMA)


def campaign_card_types(spark: SparkSession) -> DataFrame:
    return local_table(spark, CAMPAIGN_CARD_TYPES, S.CARD_TYPE_SCHEMA)


def dims(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "card_types": card_types(spark),
        "exclusions": exclusions(spark),
        "rules": rules(spark),
        "categories": categories(spark),
    }
