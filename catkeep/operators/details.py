"""Table payload rows brought together as one row per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep import model
from catkeep.functions import render
from catkeep.operators.rollup import column_lists


def column_metadata(type_json: Column) -> Column:
    """The metadata object of a column's JSON type; an empty map when there is none."""
    parsed = F.from_json(type_json, "metadata map<string,string>")["metadata"]
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(parsed, empty)


def with_column_ddl(columns: DataFrame) -> DataFrame:
    """Add ``ddl``, the clause of each column."""
    return columns.withColumn("_metadata", column_metadata(F.col("type_json"))).withColumn(
        "ddl",
        render.column_ddl(
            F.col("name"), F.col("type_text"), F.col("_metadata"), F.col("mask_function"),
            F.col("mask_columns"), F.col("nullable"), F.col("comment"),
        ),
    ).drop("_metadata")


def property_maps(rows: DataFrame, key: str) -> DataFrame:
    """Rows (key, value) per table as a map; of several values of a key the greatest counts.

    A table's distinct property keys are few, as they are all part of one statement.
    """
    single = rows.filter(F.col("key").isNotNull()).groupBy(key, "key").agg(F.max("value").alias("value"))
    entries = F.array_sort(F.collect_list(F.struct("key", "value")))
    return single.groupBy(key).agg(F.map_from_entries(entries).alias("properties"))


def constraint_arrays(rows: DataFrame, key: str) -> DataFrame:
    """Constraint rows per table as an array ordered by name; column lists are comma texts."""
    entry = F.struct(
        "name",
        "kind",
        F.split("child_columns", ",").alias("child_columns"),
        "parent_table",
        F.split("parent_columns", ",").alias("parent_columns"),
    )
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("constraints"))


def filter_structs(rows: DataFrame, key: str) -> DataFrame:
    columns = F.split("input_columns", ",").alias("input_columns")
    return rows.select(key, F.struct("name", columns).alias("row_filter"))


def table_details(
    names: DataFrame,
    key: str,
    columns: DataFrame,
    properties: DataFrame,
    constraints: DataFrame,
    row_filters: DataFrame,
) -> DataFrame:
    """Payload of the tables in ``names`` (key, object_name), ready to be rendered.

    Every payload is reduced to one row per table before it is joined.
    """
    clustering = F.from_json(F.col("properties")[model.CLUSTERING_PROPERTY], "array<string>")
    return (
        names.join(column_lists(with_column_ddl(columns), key), key, "left")
        .join(property_maps(properties, key), key, "left")
        .join(constraint_arrays(constraints, key), key, "left")
        .join(filter_structs(row_filters, key), key, "left")
        .select(
            "object_name", "columns_ddl", "partition_columns",
            clustering.alias("cluster_columns"), "properties", "constraints", "row_filter",
        )
    )

