"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import database, difference

SF = "/root/testdata/sf0.001"
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert {r["topic"] for r in contract.entry(spark).collect()} <= set(
        "events.raw events.user events.transaction events.analytics events.system events.critical".split()
    )


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
