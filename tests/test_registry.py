import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, sf, con, name):
    result = compare(queries()[name](spark, sf), con, ORACLES.get(name))
    assert result.startswith(("ok", "rows-only")), result


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())
