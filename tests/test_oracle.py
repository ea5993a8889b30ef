"""Every query against its SQL in another engine."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference, oracle_connection
from tests.conftest import SF

SQL = entry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    if name not in SQL:
        assert len(got) > 0
        return
    want = oracle_connection(SF).execute(SQL[name]).df()
    problem = difference(got, want)
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() == 30
