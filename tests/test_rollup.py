"""Roll-ups, also of objects with very many rows."""

import json

import pytest
from pyspark.sql import functions as F

from catkeep.operators import rollup
from catkeep.plans import backup


def test_grants_sort_and_repeat_once(spark):
    rows = [("a", "g", "S"), ("a", "g", "M"), ("a", "g", "S"), ("a", "h", "S"), ("b", "g", None)]
    df = spark.createDataFrame(rows, "object_name string, grantee string, privilege_type string")
    got = {tuple(row) for row in rollup.grants_per_grantee(df).collect()}
    assert got == {("a", "g", "M, S"), ("a", "h", "S")}


def test_tags_drop_pairs_without_value_and_empty_objects(spark):
    rows = [("a", "k", "v"), ("a", "j", "it's"), ("a", "n", None), ("b", "n", None)]
    df = spark.createDataFrame(rows, "object_name string, tag_name string, tag_value string")
    got = rollup.tags_per_object(df).collect()
    assert [tuple(row) for row in got] == [("a", "'j' = 'it''s', 'k' = 'v'")]


@pytest.mark.parametrize("distinct", [1, 3, 25_000])
def test_one_whole_row_per_object_at_any_size(spark, distinct):
    item = F.concat(F.lit("i"), F.lpad((F.col("id") % distinct).cast("string"), 5, "0"))
    rows = spark.range(25_000).select(F.lit("hot").alias("name"), item.alias("item"))
    want = [f"i{i:05}" for i in range(distinct)]
    tags = rows.select(F.col("name").alias("object_name"), F.col("item").alias("tag_name"), F.lit("v").alias("tag_value"))
    [row] = rollup.tags_per_object(tags).collect()
    assert row.tags == ", ".join(f"'{i}' = 'v'" for i in want)
    [row] = rollup.address_payloads(rows.toDF("recipient_name", "allowed_ip_range")).collect()
    assert json.loads(row.api_payload)["ip_access_list"]["allowed_ip_addresses"] == want
    hosts = rows.select(F.col("item").alias("external_location_name"), F.lit("s3://h/p").alias("url"))
    [row] = rollup.locations_by_host(hosts).collect()
    assert (row.host, row.external_location_names) == ("h", want)


def test_recipient_keeps_its_statement_with_very_many_ranges(spark):
    ranges = spark.range(24_000).select(
        F.concat(F.lit("r"), F.col("id") % 2).alias("recipient_name"), (F.col("id") % 12_000).cast("string").alias("allowed_ip_range")
    )
    recipients = spark.createDataFrame(
        [("r0", "o", "g", "c", None), ("r1", "o", "g", "c", None), ("r2", "o", "g", "c", None)],
        "recipient_name string, recipient_owner string, data_recipient_global_metastore_id string, comment string, last_altered timestamp_ntz",
    ).drop("last_altered")
    found = backup.entity(
        "recipients", {"recipients": recipients, "recipient_allowed_ip_ranges": ranges}, F.lit("2024-01-01").cast("timestamp_ntz"), "ms"
    ).collect()
    rows = [r for r in found if r.object_type == "RECIPIENT"]
    assert sorted(r.object_name for r in rows) == ["r0", "r1", "r2"]
    assert all(r.restore_ddl.startswith("CREATE RECIPIENT") for r in rows) and len(found) == 6


def test_address_payload_without_ranges_is_an_empty_list(spark):
    rows = [("r", None), ("s", "b"), ("s", "a")]
    df = spark.createDataFrame(rows, "recipient_name string, allowed_ip_range string")
    got = {row.recipient_name: row.api_payload for row in rollup.address_payloads(df).collect()}
    assert got["r"] == '{"ip_access_list":{"allowed_ip_addresses":[]}}'
    assert got["s"] == '{"ip_access_list":{"allowed_ip_addresses":["a","b"]}}'


def test_column_lists_do_not_depend_on_piece_size(spark):
    rows = [(t, f"c{p}", p, f"`c{p}` int", (p % 3 if p % 4 == 0 else None)) for t in (1, 2) for p in range(25)]
    df = spark.createDataFrame(rows, "t int, name string, position int, ddl string, partition_index int")
    one = {tuple(row) for row in rollup.column_lists(df, "t", piece=1000).collect()}
    many = {tuple(row) for row in rollup.column_lists(df, "t", piece=3).collect()}
    assert one == many
    text = next(iter(one))[1]
    assert text.split(",\n") == [f"`c{p}` int" for p in range(25)]
    parts = sorted((p % 3, p) for p in range(0, 25, 4))
    assert next(iter(one))[2] == ", ".join(f"`c{p}`" for _, p in parts)


def test_model_versions_are_ordered_as_numbers_in_one_row(spark):
    rows = [("m", str(v), f"run{v}") for v in range(1, 26)]
    df = spark.createDataFrame(rows, "full_name string, version string, run_id string")
    for piece in (10, 1000):
        [row] = rollup.model_payloads(df, ["version"], piece=piece).collect()
        assert row.versions_json == "[" + ",".join(f'{{"version":"{v}"}}' for v in range(1, 26)) + "]"


def test_odd_version_numbers_keep_their_places(spark):
    numbers = [None, "-11", "-1", "0", "3", "9", "9", "10", "25", "25", "1000000000000"]
    rows = [("m", v, f"r{i}") for i, v in enumerate(numbers)] + [("late", "12", "a"), (None, "1", "b"), (None, "10", "c")]
    df = spark.createDataFrame(rows[::-1], "full_name string, version string, run_id string")
    found = rollup.model_payloads(df, ["run_id"], piece=10).collect()
    got = {r.full_name: [v["run_id"] for v in json.loads(r.versions_json)] for r in found}
    assert len(found) == 3 and got == {"m": [f"r{i}" for i in range(len(numbers))], "late": ["a"], None: ["b", "c"]}
    assert rollup.model_payloads(df.limit(0), ["run_id"]).collect() == []


def test_versions_are_shuffled_as_rows_and_low_numbers_once(spark):
    df = spark.createDataFrame([("m", "1", "r")], "full_name string, version string, run_id string")
    plan = rollup.model_payloads(df, ["run_id"])._jdf.queryExecution().executedPlan().toString().split("\n")
    below = [plan[i + 1] for i, line in enumerate(plan) if "Exchange" in line]
    # Lists that are made in front of a shuffle are as large as their rows, and making them sorts all of these.
    assert not any("collect_list" in line for line in below)
    # All pass one shuffle; what is numbered above a piece passes one more, before the rows are put together.
    [union] = [i for i, line in enumerate(plan) if "Union" in line]
    assert sum("Exchange" in line for line in plan[:union]) == 1 and len(below) == 2


def test_descriptions_to_columns(spark):
    rows = [("c", "Catalog Type", "X"), ("c", "Comment", "n"), ("d", "Comment", None)]
    df = spark.createDataFrame(rows, "catalog_name string, info_name string, info_value string")
    got = {row[0]: (row[1], row[2]) for row in rollup.description_columns(df, "catalog_name", ["catalog_type", "comment"]).collect()}
    assert got == {"c": ("X", "n"), "d": (None, None)}

