"""Every registered query against its SQL text."""

import pytest
from compare import compare, oracle

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, con, sf_dir):
    if name not in SQL:
        assert entry.queries()[name](spark, sf_dir).count() > 0
        return
    ok, note = compare(entry.queries()[name], SQL[name], spark, con, sf_dir)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
