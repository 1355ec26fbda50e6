"""Scalar helpers: parses, rate text, masks."""

from decimal import Decimal

from rewardflow.functions.parse import parse_amount, parse_int
from rewardflow.functions.text import mask_pan, rate_text, unit_for


def test_parse_int_and_amount(spark):
    vals = [" 12 ", "+5", "0742", "12.0", "x", "", None, "-3"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(parse_int("v")).collect()]
    assert got == [12, 5, 742, None, None, None, None, -3]
    amts = ["10.005", ".5", "5.", "1e3", " 7.25 ", "n/a", None]
    df = spark.createDataFrame([(v,) for v in amts], "v string")
    got = [r[0] for r in df.select(parse_amount("v")).collect()]
    assert got == [Decimal("10.005"), Decimal("0.5"), Decimal("5"), Decimal("1000"), Decimal("7.25"), None, None]


def test_rate_text_units_and_mask(spark):
    df = spark.createDataFrame([(Decimal("0.0500"), 1, "4111222233334444"), (Decimal("4.0000"), 2, None),
                                (Decimal("1.2500"), 4, "12"), (Decimal("0.0125"), 1, "1234")],
                               "r decimal(10,4), ct int, pan string")
    got = df.select(rate_text("r", "ct").alias("t"), unit_for("ct").alias("u"),
                    mask_pan("pan").alias("m")).collect()
    assert [tuple(r) for r in got] == [("5.0", "cashback", "****4444"), ("4.0", "miles", None),
                                       ("1.25", "points", "****12"), ("1.25", "cashback", "****1234")]
