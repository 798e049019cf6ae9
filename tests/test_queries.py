"""Every registered query against its SQL twin, and what its plan must not hold."""

import pytest

from __spark_entry__ import entry
from queries.oracle import ORACLE as SQL
from queries.registry import QUERIES as NAMED
from queries.registry import runnable
from tests.compare import connect, differences

QUERIES = {name: runnable(name) for name in NAMED}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoop", "PythonUDF", "EvalPython", "InPandas"):
        assert unwanted not in plan, unwanted
    extra, missing, _rows = differences(df, con, SQL[name])
    assert not extra and not missing, (extra, missing)


def test_entry(spark):
    plan = entry(spark)
    assert plan.columns[0] == "phase"
    assert plan.count() > 0
