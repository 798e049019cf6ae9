"""Positions and newest rows, computed without sending one whole group to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catkeep.session import shared_folder

# Bits a partition's own row counter takes in monotonically_increasing_id().
ROW_BITS = 33


def position_in_group(
    df: DataFrame,
    keys: list[str],
    order: str,
    ties: list[str] = (),
    width: int = 1_000_000,
    name: str = "position",
) -> DataFrame:
    """1-based ``row_number`` per ``keys``, ordered by the integer ``order`` and then ``ties``.

    A group is cut at multiples of ``width`` of the order column. Rows are numbered inside a
    slice; the slice's start is the running count of the slices before it, which are few.
    """
    sliced = df.withColumn("_slice", F.floor(F.col(order) / width))
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *keys, "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*keys, "_slice").orderBy(order, *ties)
    numbered = sliced.withColumn("_row", F.row_number().over(inside))
    return (
        numbered.join(starts, [*keys, "_slice"])
        .withColumn(name, F.col("_start") + F.col("_row"))
        .drop("_slice", "_row", "_start")
    )


def overall_position(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based position of every row in one total order.

    The rows are range partitioned and sorted, and that layout is checkpointed so that the
    partition sizes and the rows are read from the same cut. Each partition then only needs
    the number of rows before it: one small row per partition.
    """
    shared_folder(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_partition", F.shiftright("_slot", ROW_BITS))
        .withColumn("_row", F.col("_slot").bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
    )
    sizes = placed.groupBy("_partition").agg((F.max("_row") + 1).alias("_n"))
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_partition", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    # One row per shuffle partition, whatever the size of df.
    return (
        placed.join(F.broadcast(starts), "_partition")
        .withColumn(name, F.col("_start") + F.col("_row") + 1)
        .drop("_slot", "_partition", "_row", "_start")
    )


def newest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row per key under ``order``.

    The planner keeps only the best row per key of each task before the shuffle
    (WindowGroupLimit), so a key that holds most of the rows arrives as one row per task.
    """
    ranked = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
