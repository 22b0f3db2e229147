"""Every registered query of the package proper against its SQL."""

import pytest
from compare import differences

import __spark_entry__ as entry_point
from quayside.plans import oracle, registry

QUERIES, SQL = registry.queries(), oracle.oracle_sql()


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 10 and sum(r["total_shipments"] for r in rows) == 5954
