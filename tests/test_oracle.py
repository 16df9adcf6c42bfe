"""Every query with an oracle, compared value by value; the others must return rows."""

from pathlib import Path

import pytest
from compare import check, connect

from staywise.plans.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    assert check(spark, con, name, SMALL, QUERIES, ORACLE) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_changes_are_found(spark):
    share = QUERIES["change_point_share"](spark, SMALL).first()["detected_share"]
    assert 0.1 <= share <= 0.6


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).columns == ["risk_tier", "churn_rate", "users"]
