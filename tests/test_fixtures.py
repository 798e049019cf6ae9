"""The Spark derivations of the inputs give the rows of their SQL twins."""

import pytest

from queries.fixture_sql import SQL
from queries.fixtures import Fixtures
from queries.oracle import with_inputs
from queries.registry import QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def fixtures(spark, sf_dir):
    return Fixtures(spark, sf_dir)


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(SQL))
def test_fixture(name, fixtures, con):
    extra, missing, rows = differences(
        getattr(fixtures, name), con, with_inputs(f"SELECT * FROM {name}")
    )
    assert not extra and not missing, (extra, missing)
    assert rows > 0


@pytest.mark.parametrize("name", ["snapshot_latest", "snapshot_diff"])
def test_rows_of_a_version_are_not_dealt_out_by_it(name, spark, sf_dir):
    """All rows of the one or two versions asked for would meet in one or two tasks."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = QUERIES[name](Fixtures(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "hashpartitioning(version" not in plan
