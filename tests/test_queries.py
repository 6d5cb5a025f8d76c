"""Every registered query: equal to its SQL where it has one, else non-empty; no cross joins."""

import os

import oracle
import pytest

import __spark_entry__ as entry_module

FOLDER = os.environ.get("VELDT_TEST_FOLDER", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    return oracle.connect(FOLDER)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, sql, key):
    df = QUERIES[key](spark, FOLDER)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    got = df.toPandas()
    assert len(set(got.columns)) == len(got.columns) and len(got)
    if key in ORACLES:
        assert oracle.difference(got, sql.execute(ORACLES[key]).df()) is None


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 19
