"""The queries that SQL can express, against DuckDB on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle_compare import compare, duck  # noqa: E402
from rewardflow.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data missing")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, name, QUERIES[name], ORACLE_SQL[name], duck(SF))
    assert res["rows"] > 0 and res["ok"], res
