from __future__ import annotations

import pytest

from riskweave.plans import registry
from tests.conftest import DATA
from tests.oracle import assert_same, connect


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert_same(registry.QUERIES[name](spark, DATA).toPandas(), con.sql(registry.ORACLES[name]).df())


def test_every_query_is_listed():
    import __spark_entry__ as entry

    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).count() == 1
