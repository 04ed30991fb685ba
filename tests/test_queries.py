"""Every registered query on the smallest tables: against SQL where there is one."""

import pytest
from harness import compare, connect

import __spark_entry__ as entry_points

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    rows = QUERIES[name](spark, SMALL).collect()
    assert rows
    for r in rows:
        for key, value in r.asDict().items():
            if key.endswith("_prediction"):
                assert value in (0, 1)


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r["split"] for r in rows} == {"validation", "test"} and len(rows) == 36
    assert all(0.0 <= r["value"] <= 1.0 for r in rows)
