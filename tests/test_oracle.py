"""Every query against its SQL on the same tables."""

import pytest
from oracle import SF_DIR, compare, connect

import __spark_entry__ as entry
from rateloom.plans.catalog import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    result = compare(spark, sf_dir, QUERIES[name], ORACLE[name], duck)
    assert result["ok"], result
