"""One key with a third of all rows: same results, and no task that gets all of them."""

import pytest
from pyspark.sql import functions as F

from catkeep.operators import selection
from catkeep.operators.ordering import position_in_group

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS).select(
        F.col("id").alias("object_uid"),
        F.concat(F.lit("t"), "id").alias("object_name"),
        F.lit("TABLE").alias("object_type"),
        F.when(hot, "c.hot").otherwise(F.concat(F.lit("c.s"), F.col("id") % 997)).alias("object_parent_name"),
        F.lit("SCHEMA").alias("object_parent_type"),
    )


def test_positions_in_the_hot_group_are_dense(skewed):
    placed = position_in_group(skewed, ["object_parent_name"], "object_uid", width=1000)
    hot = placed.filter("object_parent_name = 'c.hot'").agg(
        F.count("position"), F.countDistinct("position"), F.max("position")
    )
    assert tuple(hot.first()) == (ROWS // 3,) * 3


def test_selection_of_the_hot_schema_is_whole(skewed):
    spec = {"metastore": {"catalog": {"c": {"schema": {"c.hot": "*"}}}}}
    assert selection.select_by_spec(skewed, spec).count() == ROWS // 3
