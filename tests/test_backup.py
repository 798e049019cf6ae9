import datetime as dt

import pytest
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators import checks
from catkeep.plans import backup, restore
from catkeep.sources.snapshots import SnapshotStore
from queries.registry import runnable

DAY = dt.datetime(2024, 1, 1)
RUN = dt.datetime(2024, 2, 1)
TABLES = "table_catalog string, table_schema string, table_name string, table_type string, table_owner string, comment string, last_altered timestamp_ntz"


def tables(spark, *rows):
    """(schema, name, type, owner, days after DAY or None)."""
    data = [("c", s, n, t, o, None, None if d is None else DAY + dt.timedelta(days=d)) for s, n, t, o, d in rows]
    return spark.createDataFrame(data, TABLES)


def run_at():
    return F.lit(RUN).cast("timestamp_ntz")


def content(df):
    return sorted(map(str, df.select(*model.IDENTITY_COLUMNS).collect()))


def test_reserved_and_null_namespaces_and_kinds(spark):
    rows = [("s", "a", "MANAGED", "o", 1), ("information_schema", "b", "MANAGED", "o", 1),
            (None, "c", "MANAGED", "o", 1), ("s", "d", "FOREIGN", "o", 1), ("default", "e", "EXTERNAL", "o", 1),
            ("s", "never", "MANAGED", "o", None)]
    source = tables(spark, *rows)
    others = source.filter("table_name = 'a'")
    vendor = others.withColumn("table_catalog", F.lit("__sales_internal"))
    system = others.withColumn("table_catalog", F.lit("system"))
    every = source.unionByName(vendor).unionByName(system)
    got = backup.entity("tables", {"tables": every}, run_at(), "ms").collect()
    # Only exact names are reserved; further catalogs are left out when the caller names them.
    user = "__sales_internal.s.a"
    assert {row.object_name for row in got} == {"c.s.a", "c.default.e", "c.s.never", user}
    got = backup.entity("tables", {"tables": every}, run_at(), "ms", ["__sales_internal"]).collect()
    assert {row.object_name for row in got} == {"c.s.a", "c.default.e", "c.s.never"}
    # Schemas and catalogs have longer lists than tables.
    schemata = spark.createDataFrame(
        [("c", "default", "o", None), ("main", "s", "o", None), ("c", "s", "o", None)],
        "catalog_name string, schema_name string, schema_owner string, comment string",
    )
    kept = backup.entity("schemas", {"schemata": schemata}, run_at(), "ms").collect()
    assert {row.object_name for row in kept} == {"c.s"}


def test_owner_rows(spark):
    source = {"tables": tables(spark, ("s", "a", "MANAGED", "it", 1), ("s", "b", "MANAGED", None, 1))}
    got = {(r.object_name, r.object_type): r for r in backup.entity("tables", source, run_at(), "ms").collect()}
    owner = got[("c.s.a", "OWNER")]
    assert owner.restore_ddl == "ALTER TABLE `c`.`s`.`a` SET OWNER TO `it`"
    assert (owner.object_parent_name, owner.object_parent_type) == ("c.s.a", "TABLE")
    assert owner.object_cross_relationship == "it" and owner.api_payload is None
    assert got[("c.s.b", "OWNER")].restore_ddl is None
    assert got[("c.s.a", "TABLE")].object_parent_name == "c.s"


def test_ids_tell_nulls_apart_and_ignore_the_run_time(spark):
    fields = ", ".join(f"{name} string" for name in model.IDENTITY_COLUMNS)
    df = spark.createDataFrame(
        [("a", "T", "p", "S", "x", "d", None), ("a", "T", "p", "S", "x", None, "d")], fields
    )
    first = backup.identified(df, F.lit(DAY))
    later = backup.identified(df, F.lit(RUN))
    ids = [row.object_uid for row in first.collect()]
    assert len(set(ids)) == 2
    assert sorted(ids) == sorted(row.object_uid for row in later.collect())
    assert first.columns == model.INVENTORY_COLUMNS


@pytest.fixture
def sources(spark):
    return {
        "tables": tables(
            spark, ("s", "old", "MANAGED", "o", 1), ("s", "new", "MANAGED", "o", 9), ("s", "changed", "MANAGED", "p", 8),
            ("s", "failed", "EXTERNAL", "o", 1), ("s", "undated", "MANAGED", "o", None), ("s", "fresh", "MANAGED", "o", None),
        )
    }


@pytest.fixture
def past(spark):
    """The snapshot of day 5; the statement of c.s.failed could not be made then."""
    before = tables(
        spark, ("s", "old", "MANAGED", "o", 1), ("s", "changed", "MANAGED", "o", 2), ("s", "failed", "EXTERNAL", "o", 1),
        ("s", "gone", "MANAGED", "o", 1), ("s", "undated", "MANAGED", "o", None),
    )
    at = F.lit(DAY + dt.timedelta(days=5)).cast("timestamp_ntz")
    whole = backup.entity("tables", {"tables": before}, at, "ms")
    broken = (F.col("object_name") == "c.s.failed") & (F.col("object_type") == "TABLE")
    return whole.withColumn("restore_ddl", F.when(~broken, F.col("restore_ddl")))


def test_refresh_set(sources, past):
    got = {row.object_name for row in backup.tables_to_refresh(sources, past).collect()}
    assert got == {"c.s.new", "c.s.changed", "c.s.failed", "c.s.fresh"}


def test_incremental_equals_full(sources, past):
    merged = backup.incremental_backup(sources, past, run_at(), "ms")
    full = backup.full_backup(sources, run_at(), "ms")
    assert content(merged) == content(full)
    stamps = {row.object_name: row.created_tsp for row in merged.collect()}
    assert stamps["c.s.old"] == DAY + dt.timedelta(days=5) and stamps["c.s.new"] == RUN
    uids = [row.object_uid for row in merged.collect()]
    assert len(uids) == len(set(uids))


def test_declarations_kept_one_by_one(spark, sources, past, tmp_path):
    """With ``keep`` every declaration is a run of its own, models in parts; the rows are the same."""
    kept, store = [], SnapshotStore(spark, str(tmp_path))
    numbers = spark.range(40).selectExpr("IF(id % 10 = 9, NULL, concat('c.s.m_', id)) AS full_name", "concat('m_', id) AS name")
    sources["models"] = numbers.selectExpr("full_name", "'c' AS catalog_name", "'s' AS schema_name", "name", "'o' AS owner")
    sources["model_versions"] = numbers.selectExpr("full_name", "explode(array('1', '2')) AS version", "'r' AS run_id")

    def keep(df):
        kept.append(df)
        return store.stage(df)

    full = backup.full_backup(sources, run_at(), "ms")
    one_by_one = backup.full_backup(sources, run_at(), "ms", keep=keep)
    assert len(kept) == 1 + backup.PIECES
    assert content(one_by_one) == content(full)
    merged = backup.incremental_backup(sources, past, run_at(), "ms", keep=keep)
    assert content(merged) == content(full)
    # All come from stored rows: nothing is shuffled to read them.
    assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString()


def test_first_incremental_run_is_a_full_one(sources, past):
    nothing = past.limit(0)
    assert backup.watermark(nothing).first()[0] == dt.datetime(1900, 1, 1)
    assert content(backup.incremental_backup(sources, nothing, run_at(), "ms")) == content(
        backup.full_backup(sources, run_at(), "ms")
    )


def test_recipients(spark):
    people = spark.createDataFrame(
        [("r", "o", "", "n"), ("q", "o", "gid", None)],
        "recipient_name string, recipient_owner string, data_recipient_global_metastore_id string, comment string",
    )
    ranges = spark.createDataFrame([("r", "b"), ("r", "a"), ("r", None)], "recipient_name string, allowed_ip_range string")
    got = backup.entity("recipients", {"recipients": people, "recipient_allowed_ip_ranges": ranges}, run_at(), "ms")
    rows = {(r.object_name, r.object_type): r for r in got.collect()}
    assert rows[("r", "RECIPIENT")].restore_ddl == "CREATE RECIPIENT `r`\nCOMMENT 'n'"
    assert rows[("r", "RECIPIENT")].api_payload == '{"ip_access_list":{"allowed_ip_addresses":["a","b"]}}'
    assert rows[("q", "RECIPIENT")].restore_ddl == "CREATE RECIPIENT `q`\nUSING ID 'gid'"
    assert rows[("q", "RECIPIENT")].api_payload is None


def test_connection_grants_need_a_connection_and_a_privilege(spark):
    connections = spark.createDataFrame([("k",)], "connection_name string")
    grants = spark.createDataFrame(
        [("k", "g", "USE"), ("k", "h", None), ("x", "g", "USE")],
        "connection_name string, grantee string, privilege_type string",
    )
    got = backup.entity(
        "connection_privileges", {"connections": connections, "connection_grants": grants}, run_at(), "ms"
    ).collect()
    assert [(r.restore_ddl, r.object_parent_type) for r in got] == [("GRANT USE ON CONNECTION `k` TO `g`", "CONNECTION")]


def test_share_grants_drop_blank_names(spark):
    rows = [("s", "r", "SELECT"), ("s", "", "SELECT"), ("s", None, "SELECT"), ("", "r", "SELECT")]
    grants = spark.createDataFrame(rows, "share_name string, recipient_name string, privilege_type string")
    got = backup.entity("share_recipient_privileges", {"share_recipient_privileges": grants}, run_at(), "ms").collect()
    assert [r.restore_ddl for r in got] == ["GRANT SELECT ON SHARE `s` TO RECIPIENT `r`"]
    assert got[0].object_cross_relationship is None


def test_materialised_views_and_their_grants_stay_out(spark):
    rows = tables(spark, ("s", "v", "VIEW", "o", 1), ("s", "m", "VIEW", "o", 1), ("s", "t", "EXTERNAL", "o", 1))
    views = spark.createDataFrame(
        [("c", "s", "v", False), ("c", "s", "m", True)],
        "table_catalog string, table_schema string, table_name string, is_materialized boolean",
    )
    grants = spark.createDataFrame(
        [("c", "s", n, "g", "SELECT", i) for n in "vmt" for i in ("NONE", "CATALOG")],
        "table_catalog string, table_schema string, table_name string, grantee string, privilege_type string, inherited_from string",
    )
    tags = spark.createDataFrame(
        [("c", "s", n, "k", "v") for n in "vmt"],
        "catalog_name string, schema_name string, table_name string, tag_name string, tag_value string",
    )
    sources = {"tables": rows, "views": views, "table_privileges": grants, "table_tags": tags}
    seen = backup.entity("views", sources, run_at(), "ms").filter("object_type = 'VIEW'").collect()
    assert [r.object_name for r in seen] == ["c.s.v"] and seen[0].restore_ddl is None
    for key in ("table_view_privileges", "table_view_tags"):
        kinds = {(r.object_name, r.object_parent_type) for r in backup.entity(key, sources, run_at(), "ms").collect()}
        assert kinds == {("c.s.v", "VIEW"), ("c.s.t", "TABLE")}


def test_models_through_payload(spark):
    models = spark.createDataFrame([("c.s.m", "c", "s", "m", 'o"x')], "full_name string, catalog_name string, schema_name string, name string, owner string")
    versions = spark.createDataFrame(
        [("c.s.m", "10", "r10", ["a"]), ("c.s.m", "9", "r9", None)],
        "full_name string, version string, run_id string, aliases array<string>",
    )
    got = backup.entity("registered_models", {"models": models, "model_versions": versions}, run_at(), "ms")
    owner = got.filter("object_type = 'OWNER'").first()
    assert owner.restore_ddl is None and owner.api_payload == '{"full_name":"c.s.m","owner":"o\\"x"}'
    plan = [(r.version_number, r.run_id, r.aliases) for r in restore.model_versions_plan(got).collect()]
    assert sorted(plan) == [(9, "r9", None), (10, "r10", ["a"])]


def test_contents_are_counted_by_digests_in_bytes(spark, sf_dir):
    counted = runnable("backup_ids")(spark, sf_dir)._jdf.queryExecution().analyzed()
    assert counted.child().schema().apply("content").dataType().simpleString() == "binary"


def test_checks(spark, past):
    catalog = past.limit(1).withColumns(
        {"object_name": F.lit("shared"), "object_type": F.lit("CATALOG"), "restore_ddl": F.lit("CREATE CATALOG x USING SHARE y")}
    )
    below = past.limit(1).withColumns({"object_name": F.lit("shared.s.t"), "restore_ddl": F.lit(None).cast("string")})
    got = checks.unrestorable_objects(past.unionByName(catalog).unionByName(below)).collect()
    assert [(r.catalog, r.object_name) for r in got] == [("c", "c.s.failed")]
    assert checks.is_empty(past.limit(0)).first()[0] and not checks.is_empty(past).first()[0]
