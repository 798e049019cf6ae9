"""Queries that SQL can express, against DuckDB on whole tables."""

import pytest

from catkeep.llm.queries import QUERIES
from catkeep.llm.sql import SQL
from tests.compare import connect, differences


@pytest.mark.parametrize("name", list(SQL))
def test_twin(name, spark, sf_dir):
    extra, missing, rows = differences(QUERIES[name](spark, sf_dir), connect(sf_dir), SQL[name])
    assert not extra and not missing, (extra, missing)
    assert rows


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
