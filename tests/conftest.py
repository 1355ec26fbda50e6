import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from rewardflow import schemas as S  # noqa: E402
from rewardflow.sources import testviews as tv  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from rewardflow.session import build_session
    s = build_session("local[4]", app="rewardflow-tests", shuffle_partitions=4)
    yield s
    s.stop()


def spend_rows(spark, rows):
    """Spend frame from partial dicts; unspecified fields get valid defaults."""
    base = dict(id="r", transaction_id=None, merchant="SHOP", mcc="5000", currency="SGD",
                amount="100.00", transaction_date="2021-09-03", card_id="c1",
                card_pan="4111111111111111", card_type="shop")
    out = []
    for i, r in enumerate(rows):
        d = dict(base, id=f"r{i}", transaction_id=f"t{i}")
        d.update(r)
        out.append(tuple(d[c] for c in S.SPEND_COLUMNS))
    return spark.createDataFrame(out, S.SPEND_SCHEMA)


CARD_TYPES = [(1, "shop", "t1"), (2, "free", "t1"), (3, "plat", "t1"), (4, "prem", "t1"),
              (5, "extra", "t1"), (1, "shop", "t2")]


def rule(title, ct, rate, end_date=None, active=True, foreign=None, min_spend=None,
         merchant=None, category=None):
    return (title, ct, end_date, active, foreign,
            None if min_spend is None else Decimal(str(min_spend)),
            merchant, category, Decimal(str(rate)))


def dims(spark, rules=(), exclusions=(), categories=()):
    return {
        "card_types": tv.local_table(spark, CARD_TYPES, S.CARD_TYPE_SCHEMA),
        "exclusions": tv.local_table(spark, list(exclusions) or [(99, 99, "none")], S.EXCLUSION_SCHEMA),
        "rules": tv.local_table(spark, list(rules) or [rule("none", 99, 0)], S.RULE_SCHEMA),
        "categories": tv.local_table(spark, list(categories) or [("none", 99, "none")],
                                     S.CATEGORY_SCHEMA),
    }
