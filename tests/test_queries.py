"""Every query against its SQL twin on the smallest tables, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as driver
from catalog.oracle import ORACLE_SQL
from catalog.queries import QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE_SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLE_SQL[name], SF) == []


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["node", "rank"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if "round" not in n and "stream" not in n))
def test_no_pairwise_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
