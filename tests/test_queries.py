"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

ORACLES = {k: v for k, v in entry.oracle_sql().items() if not k.startswith("op") and k != "pipeline"}
QUERIES = {k: v for k, v in entry.queries().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def engine(small):
    return connect(small)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_agrees_with_sql(spark, small, engine, key):
    df = QUERIES[key](spark, small)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("NestedLoop", "Cartesian", "Python") if word in plan]
    assert differences(df, engine, ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, small, key):
    assert QUERIES[key](spark, small).count() > 0


def test_flagship_query(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"Segment", "OrderDateYear", "Revenue", "Orders", "Customers"} <= set(rows.columns)
