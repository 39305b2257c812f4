"""Every registered query against its SQL, and what their plans must not hold."""

import pytest

import __spark_entry__ as entry_point
from quirelake.plans.catalogue import QUERIES as CATALOGUE
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"
SQL = entry_point.oracle_sql()
#: queries without SQL have tests of their own beside them
QUERIES = {name: q for name, q in entry_point.queries().items() if name in CATALOGUE}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(CATALOGUE) and set(CATALOGUE) <= set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython",
                 "MapInPandas", "FlatMapGroups"):
        assert node not in plan, node
    assert difference(df, duck, SQL[name]) is None


def test_entry(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
