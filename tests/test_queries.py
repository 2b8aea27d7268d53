from __future__ import annotations

import pytest
from agreement import assert_agrees, connection

import __spark_entry__
from lakeloom.plans import registry


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_agrees_with_sql(spark, sf_dir, con, name):
    assert_agrees(registry.QUERIES[name](spark, sf_dir), con, registry.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, sf_dir, name):
    registry.QUERIES[name](spark, sf_dir).collect()


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = registry.QUERIES["pushed_filters"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull" in plan and "Exchange" not in plan


def test_disjunction_needs_no_nested_loop(spark, sf_dir):
    plan = registry.QUERIES["disjunctive_join"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
