"""Many source rows to one row per object: grants, tags, address lists, hosts, columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep.functions import render
from catkeep.functions.text import info_key, literal, storage_host, ticked

# Items joined into one piece before the pieces of a group meet.
PIECE = 1_000
# Ways the items of one object are spread before its lists meet.
BUCKETS = 32


def sorted_list(item: str | Column) -> Column:
    """Distinct non-null values in order."""
    return F.array_sort(F.collect_set(item))


def gathered(rows: DataFrame, keys: list[str], item: str) -> DataFrame:
    """``items``: the distinct non-null items of every group, in order.

    Repeats go first, per group and bucket of items, where the rows are and then in as many tasks as
    there are buckets. Only the distinct items of a group meet: they become one text or array, so
    they are bounded by what a single value may hold (2 GB), whatever the number of rows.
    """
    spread = rows.withColumn("_bucket", F.pmod(F.xxhash64(item), F.lit(BUCKETS)))
    parts = spread.groupBy(*keys, "_bucket").agg(F.collect_set(item).alias("_items"))
    return parts.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_items"))).alias("items"))


def grants_per_grantee(df: DataFrame) -> DataFrame:
    """(object_name, grantee, privileges) from rows with one privilege_type each.

    Distinct privileges are what is collected, so a group is bounded by the catalog's
    vocabulary of privileges and repeats fold before the shuffle.
    """
    return (
        df.filter(F.col("privilege_type").isNotNull())
        .groupBy("object_name", "grantee")
        .agg(F.array_join(sorted_list("privilege_type"), ", ").alias("privileges"))
    )


def share_grant_statements(df: DataFrame) -> DataFrame:
    """One GRANT per share and recipient; blank names are dropped."""
    named = df.filter((F.col("share_name") != "") & (F.col("recipient_name") != ""))
    return (
        named.filter(F.col("privilege_type").isNotNull())
        .groupBy("share_name", "recipient_name")
        .agg(F.array_join(sorted_list("privilege_type"), ", ").alias("privileges"))
        .withColumn(
            "restore_ddl",
            render.share_grant(F.col("privileges"), F.col("share_name"), F.col("recipient_name")),
        )
    )


def tags_per_object(df: DataFrame) -> DataFrame:
    """(object_name, tags) from rows (object_name, tag_name, tag_value); pairs without a value are dropped."""
    pairs = df.select(
        "object_name",
        F.concat(literal(F.col("tag_name")), F.lit(" = "), literal(F.col("tag_value"))).alias("pair"),
    ).filter(F.col("pair").isNotNull())
    return gathered(pairs, ["object_name"], "pair").select(
        "object_name", F.array_join("items", ", ").alias("tags")
    )


def address_payloads(ranges: DataFrame) -> DataFrame:
    """All allowed address ranges of a recipient as one JSON payload."""
    allowed = F.struct(F.col("items").alias("allowed_ip_addresses"))
    return gathered(ranges, ["recipient_name"], "allowed_ip_range").select(
        "recipient_name", F.to_json(F.struct(allowed.alias("ip_access_list"))).alias("api_payload")
    )


def locations_by_host(locations: DataFrame) -> DataFrame:
    """Names of the external locations on each storage host."""
    hosted = locations.filter(
        F.col("external_location_name").isNotNull() & F.col("url").isNotNull()
    ).select(storage_host(F.col("url")).alias("host"), "external_location_name")
    return gathered(hosted, ["host"], "external_location_name").withColumnRenamed(
        "items", "external_location_names"
    )


def bindings(workspaces: DataFrame) -> DataFrame:
    """Workspaces a catalog is bound to, as JSON; an account has a bounded set of workspaces."""
    return workspaces.groupBy("catalog_name").agg(
        F.to_json(F.struct(sorted_list("workspace_id").alias("assign_workspaces"))).alias(
            "api_payload"
        )
    )


def column_lists(columns: DataFrame, key: str, piece: int = PIECE) -> DataFrame:
    """Column clause and partition list per table, in position order.

    Rendering and sorting happen per slice of ``piece`` positions, so a very wide table is
    spread over tasks and only finished text of it meets in the last step.
    """
    partitioned = F.when(
        F.col("partition_index").isNotNull(),
        F.struct("partition_index", "position", ticked(F.col("name")).alias("column")),
    )
    slices = (
        columns.withColumn("_slice", F.floor(F.col("position") / piece))
        .groupBy(key, "_slice")
        .agg(
            F.array_sort(F.collect_list(F.struct("position", "ddl"))).alias("_columns"),
            F.collect_list(partitioned).alias("_partitions"),
        )
        .select(
            key,
            "_slice",
            F.array_join(F.col("_columns.ddl"), ",\n").alias("_text"),
            "_partitions",
        )
    )
    joined = slices.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("_slice", "_text"))).alias("_texts"),
        F.array_sort(F.flatten(F.collect_list("_partitions"))).alias("_partitions"),
    )
    partition_text = F.array_join(F.col("_partitions.column"), ", ")
    return joined.select(
        key,
        F.array_join(F.col("_texts._text"), ",\n").alias("columns_ddl"),
        F.when(partition_text != "", partition_text).alias("partition_columns"),
    )


def model_payloads(versions: DataFrame, version_fields: list[str], piece: int = PIECE) -> DataFrame:
    """All versions of a model as one JSON array text in version order.

    Versions numbered below ``piece``, which is all that most models have, meet by model at once. Higher ones, and
    those without a number, are first joined per slice of ``piece`` numbers, in as many tasks. A list is no smaller
    than its rows, so rows are shuffled as they are: collected in front of the shuffle, all would be sorted there too.
    """
    number, is_early = F.col("_number"), F.coalesce(F.col("_number").between(0, piece - 1), F.lit(False))

    def in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
        lists = rows.repartition(*keys).groupBy(*keys).agg(
            F.min("_number").alias("_number"), F.array_sort(F.collect_list(F.struct("_number", "_json"))).alias("_entries")
        )
        return lists.select("full_name", "_number", F.array_join(F.col("_entries._json"), ",").alias("_json"))

    entries = versions.select(
        "full_name", F.col("version").cast("long").alias("_number"), F.to_json(F.struct(*version_fields)).alias("_json")
    )
    sliced = entries.filter(~is_early).withColumn("_slice", F.floor(number / piece))
    pieces = in_order(sliced, ["full_name", "_slice"])
    return in_order(entries.filter(is_early).unionByName(pieces), ["full_name"]).select(
        "full_name", F.concat(F.lit("["), F.col("_json"), F.lit("]")).alias("versions_json")
    )


def description_columns(rows: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Key/value description rows to one row per object with the named fields as columns."""
    label = info_key(F.col("info_name"))
    return rows.groupBy(key).agg(
        *[F.max(F.when(label == field, F.col("info_value"))).alias(field) for field in fields]
    )
