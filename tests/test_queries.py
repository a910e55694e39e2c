"""Every registered query beside its SQL, and the entry points."""

import pytest
from check import compare
from conftest import DATA

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in SQL:
        problems, _ = compare(df, duck, SQL[name])
        assert not problems
    else:
        assert df.count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "date", "value", "smooth", "per_100k"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
