"""Every registered query with SQL agrees with an independent engine, names and types included."""

import pytest

from checks.catalog import CATALOG
from checks.compare import compare, connect

import __spark_entry__ as entry_point


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [name for name, query in CATALOG.items() if query.sql is not None])
def test_query_matches_sql(spark, sf, duck, name):
    outcome = compare(spark, sf, name, duck)
    assert outcome["problem"] is None, outcome
    assert outcome["rows"] > 0


def test_entry_point(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).columns[0] == "phone"
