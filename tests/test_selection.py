import time

import pytest
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators import outcomes, selection
from catkeep.plans import restore

SCHEMA = (
    "object_uid long, object_name string, object_type string, object_parent_name string, "
    "object_parent_type string, object_cross_relationship string, restore_ddl string, api_payload string"
)
ROWS = [
    ("k1", "STORAGE CREDENTIAL", "ms", "METASTORE"),
    ("k2", "STORAGE CREDENTIAL", "ms", "METASTORE"),
    ("l1", "EXTERNAL LOCATION", "k1", "STORAGE CREDENTIAL"),
    ("l2", "EXTERNAL LOCATION", "k2", "STORAGE CREDENTIAL"),
    ("c", "CATALOG", "ms", "METASTORE"),
    ("d", "CATALOG", "ms", "METASTORE"),
    ("c.s", "SCHEMA", "c", "CATALOG"),
    ("c.r", "SCHEMA", "c", "CATALOG"),
    ("d.s", "SCHEMA", "d", "CATALOG"),
    ("c.s.t", "TABLE", "c.s", "SCHEMA"),
    ("c.s.u", "TABLE", "c.s", "SCHEMA"),
    ("c.s.v", "VIEW", "c.s", "SCHEMA"),
    ("c.r.t", "TABLE", "c.r", "SCHEMA"),
    ("d.s.t", "TABLE", "d.s", "SCHEMA"),
    ("c.s", "OWNER", "c.s", "SCHEMA"),
    ("c.s.t", "OWNER", "c.s.t", "TABLE"),
    ("c.s.t", "TAG", "c.s.t", "TABLE"),
    ("c.s.v", "PRIVILEGE", "c.s.v", "VIEW"),
    ("c.s.t", "PRIVILEGE", "c.s.t", "VIEW"),
    ("sh", "SHARE", "ms", "METASTORE"),
    ("sh", "DELTA SHARING SHARE OBJECT", "sh", "SHARE"),
    ("orphan", "OWNER", None, None),
]


@pytest.fixture(scope="module")
def inventory(spark):
    data = [(i, n, t, p, pt, "x", "ddl", None) for i, (n, t, p, pt) in enumerate(ROWS)]
    return spark.createDataFrame(data, SCHEMA).cache()


def picked(df):
    return {(row.object_name, row.object_type) for row in df.collect()}


def meta(**kinds):
    return {"metastore": {key.replace("_", " "): value for key, value in kinds.items()}}


def in_catalog(value):
    return meta(catalog={"c": {"schema": {"c.s": value}}})


C_S = {("c", "CATALOG"), ("c.s", "SCHEMA")}
BELOW_S = {("c.s.t", "TABLE"), ("c.s.u", "TABLE"), ("c.s.v", "VIEW"), ("c.s", "OWNER")}
WHOLE_C = C_S | BELOW_S | {("c.r", "SCHEMA"), ("c.r.t", "TABLE")}


@pytest.mark.parametrize(
    ("spec", "want"),
    [
        (meta(storage_credential="*"), {r[:2] for r in ROWS if r[1] in ("STORAGE CREDENTIAL", "EXTERNAL LOCATION")}),
        (meta(storage_credential=["k1"]), {("k1", "STORAGE CREDENTIAL"), ("l1", "EXTERNAL LOCATION")}),
        (meta(share="*"), {("sh", "SHARE")}),
        (meta(share=["nope"]), set()),
        (meta(external_location=["l2"]), {("l2", "EXTERNAL LOCATION")}),
        (meta(catalog="*"), {r[:2] for r in ROWS if r[1] in ("CATALOG", "SCHEMA") or r[3] == "SCHEMA"}),
        (meta(catalog={"c": "*"}), WHOLE_C),
        (meta(catalog={"c": {"schema": "*"}}), WHOLE_C),
        (meta(catalog={"c": {}}), {("c", "CATALOG")}),
        (in_catalog("*"), C_S | BELOW_S),
        (in_catalog({"view": "*"}), C_S | {("c.s.v", "VIEW")}),
        (in_catalog({"table": ["c.s.u", "c.r.t"]}), C_S | {("c.s.u", "TABLE")}),
        (in_catalog({}), C_S),
        (meta(), set()),
    ],
)
def test_branches(inventory, spec, want):
    assert picked(selection.select_by_spec(inventory, spec)) == want


def test_everything_includes_rows_without_parent(inventory):
    assert selection.select_by_spec(inventory, {"metastore": "*"}).count() == len(ROWS)


@pytest.mark.parametrize(
    "spec",
    [
        {},
        {"metastore": ["x"]},
        meta(unknown="*"),
        meta(share="one"),
        meta(share=[1]),
        meta(catalog=["c"]),
        meta(catalog={"c": ["s"]}),
        meta(catalog={"c": {"table": "*"}}),
        meta(catalog={"c": {"schema": ["s"]}}),
        in_catalog(["t"]),
        in_catalog({"index": "*"}),
        in_catalog({"table": "t"}),
    ],
)
def test_bad_specs(spec):
    with pytest.raises(ValueError):
        selection.read_spec(spec)


def test_dependents(inventory):
    got = picked(selection.with_dependents(inventory, in_catalog({"table": ["c.s.t"]})))
    hanging = {("c.s", "OWNER"), ("c.s.t", "OWNER"), ("c.s.t", "TAG"), ("c.s.t", "PRIVILEGE")}
    assert got == C_S | {("c.s.t", "TABLE")} | hanging
    by_kind = selection.with_dependents(inventory, in_catalog({"table": ["c.s.t"]}), match_parent_type=True)
    assert got - picked(by_kind) == {("c.s.t", "PRIVILEGE")}
    share = picked(selection.with_dependents(inventory, meta(share=["sh"])))
    assert share == {("sh", "SHARE"), ("sh", "DELTA SHARING SHARE OBJECT")}


def test_each_row_comes_once(inventory):
    for spec in (meta(catalog={"c": "*"}), meta(catalog="*"), {"metastore": "*"}):
        ids = [row.object_uid for row in selection.with_dependents(inventory, spec).collect()]
        assert len(ids) == len(set(ids))


def test_selecting_twice_changes_nothing(inventory):
    spec = meta(catalog={"c": "*"}, share="*")
    once = selection.select_by_spec(inventory, spec)
    assert picked(selection.select_by_spec(once, spec)) == picked(once)


@pytest.fixture(scope="module")
def log(spark):
    rows = [(1, 9, "Succeeded"), (1, 9, "Failed"), (1, 10, "Failed"), (2, 10, "Succeeded"), (1, None, "Succeeded")]
    return spark.createDataFrame(rows, "jobid long, rowid long, status string")


def test_remaining_and_done_make_up_the_selection(inventory, log):
    chosen = selection.with_dependents(inventory, {"metastore": "*"})
    left = {row.object_uid for row in selection.remaining_work(chosen, log, 1).collect()}
    assert left == set(range(len(ROWS))) - {9}


def test_a_restart_shuffles_what_is_left(spark):
    """Statements of objects that are done are left out before the shuffle that settles repeats."""
    names = [f"concat('x', id) AS {name}" for name in model.IDENTITY_COLUMNS]
    chosen = spark.range(1000).selectExpr("IF(id < 5, NULL, id) AS object_uid", *names)
    log = spark.range(1000).selectExpr("1L AS jobid", "id AS rowid", "IF(id % 100 = 7, 'Failed', 'Succeeded') AS status")
    whole, short = (selection.remaining_work(chosen, log, 1, mostly_done=m) for m in (False, True))
    assert sorted(map(str, short.collect())) == sorted(map(str, whole.collect())) and short.count() == 15
    nothing = selection.remaining_work(chosen, log.filter("false"), 1, mostly_done=True)
    assert nothing.count() == 1000
    assert "getbit" in short._jdf.queryExecution().optimizedPlan().toString()


def test_remaining_keeps_rows_without_id_apart(spark, inventory, log):
    no_ids = inventory.withColumn("object_uid", F.lit(None).cast("long"))
    twice = inventory.unionByName(inventory).unionByName(no_ids).unionByName(no_ids)
    assert selection.remaining_work(twice, log, 7).count() == 2 * len(ROWS)


def test_plan_phases_and_stages(inventory, log):
    plan = restore.restore_plan(inventory, {"metastore": "*"}, log, 1).collect()
    assert [row.phase for row in plan] == sorted(row.phase for row in plan)
    assert plan[0].object_type == "STORAGE CREDENTIAL" and plan[-1].object_type == "OWNER"
    stages = {(row.object_type, row.object_parent_type): row.stage for row in plan}
    assert stages[("TABLE", "SCHEMA")] == stages[("OWNER", "TABLE")] == "table"
    assert stages[("OWNER", "SCHEMA")] == stages[("TAG", "TABLE")] == stages[("VIEW", "SCHEMA")] == "post"
    assert stages[("SHARE", "METASTORE")] == stages[("CATALOG", "METASTORE")] == "pre"
    parents = {row.object_uid: row.object_parent_name for row in plan}
    assert parents[15] == "c.s"


def test_groups_are_balanced(spark):
    rows = [(i, f"c.s{i % 23}.t{i}", "TABLE", f"c.s{i % 23}", "SCHEMA", "x", "d", None) for i in range(300)]
    tables = spark.createDataFrame(rows, SCHEMA)
    groups = restore.schema_groups(tables, 8).collect()
    sizes = [sum(row.group_id == g for row in groups) for g in range(8)]
    assert sum(sizes) == 23 and max(sizes) - min(sizes) <= 1
    first = max(groups, key=lambda row: (row.object_count, [-ord(c) for c in row.object_parent_name]))
    assert first.group_id == 1
    plan = restore.plan_rows(tables)
    frame = spark.createDataFrame(groups)
    assert sum(restore.group_slice(plan, frame, g).count() for g in range(8)) == 300


def test_route(inventory):
    assert restore.route(inventory, threshold=3).first()["route"] == "sharded"
    assert restore.route(inventory, threshold=4).first()["route"] == "single"


def test_executor_statements(inventory):
    got = restore.executor_statements(inventory, selection.select_by_spec(inventory, meta(share="*")), "me")
    texts = {row.statement for row in got.collect()}
    assert "GRANT ALL PRIVILEGES ON CATALOG `c` TO `me`" in texts
    assert "REVOKE ALL PRIVILEGES ON EXTERNAL LOCATION `l1` FROM `me`" in texts
    assert "ALTER SHARE `sh` SET OWNER TO `me`" in texts
    assert len(texts) == 2 * 6 + 1


def test_outcomes_cover_the_selection(spark, inventory):
    failures = spark.createDataFrame([(3, "boom"), (3, "again")], "object_uid long, error_message string")
    rows = outcomes.record_outcomes(inventory, failures).collect()
    assert {row.object_uid for row in rows} == set(range(len(ROWS)))
    assert [row.error_message for row in rows if row.status == "Failed"] == ["boom", "again"]
    no_ids = inventory.withColumn("object_uid", F.lit(None).cast("long"))
    assert outcomes.record_outcomes(no_ids, failures).filter("status = 'Succeeded'").count() == len(ROWS)


def listed_spec(tables, schemas=1):
    """A specification that names tables of ``schemas`` schemas one by one."""
    named = {f"c.x{i}": {"table": [f"c.x{i}.t{j}" for j in range(tables)], "view": "*"} for i in range(schemas - 1)}
    return meta(
        catalog={"c": {"schema": {"c.s": {"table": [f"c.s.u{i}" for i in range(tables)] + ["c.s.t"]}} | named}, "d": "*"},
        share="*",
        storage_credential=["k2"],
    )


def test_a_table_of_rules_selects_what_a_filter_does(inventory, monkeypatch):
    for spec in (
        listed_spec(3), in_catalog("*"), meta(catalog="*"), {"metastore": "*"}, meta(catalog={"c": "*", "d": "*"}),
        in_catalog({"view": "*", "table": ["c.s.u"]}), meta(storage_credential=["k1"], catalog={"c": {}}),
    ):
        for select in (selection.select_by_spec, selection.with_dependents):
            monkeypatch.setattr(selection, "FILTER_VALUES", 200)
            wanted = sorted(select(inventory, spec).collect(), key=str)
            monkeypatch.setattr(selection, "FILTER_VALUES", 0)
            assert sorted(select(inventory, spec).collect(), key=str) == wanted


def test_rules_with_any_mask(spark, inventory):
    rules = spark.createDataFrame(
        [("TABLE", None, None, "c.r"), (None, "sh", None, None), (None, "sh", None, None), (None, "c.s.v", "SCHEMA", "c.s")],
        ", ".join(f"{n} string" for n in selection.RULE_COLUMNS),
    )
    assert picked(selection.select_by_rules(inventory, rules)) == {
        ("c.r.t", "TABLE"), ("sh", "SHARE"), ("sh", "DELTA SHARING SHARE OBJECT"), ("c.s.v", "VIEW"),
    }
    assert selection.select_by_rules(inventory, rules.filter("false")).count() == 0
    everything = spark.createDataFrame([(None,) * 4], rules.schema)
    assert selection.select_by_rules(inventory, everything).count() == len(ROWS)


def test_fifty_thousand_names(inventory):
    def planned(spec):
        started = time.perf_counter()
        df = selection.with_dependents(inventory, spec)
        text = df._jdf.queryExecution().executedPlan().toString()
        return df, text, time.perf_counter() - started

    planned(listed_spec(400, 3))
    small, few, _ = planned(listed_spec(400, 3))
    large, many, seconds = planned(listed_spec(200, 250))
    assert seconds < 2
    assert few.count("\n") == many.count("\n")
    assert picked(large) >= {("c.s.t", "TABLE"), ("c.s", "SCHEMA"), ("d.s.t", "TABLE"), ("l2", "EXTERNAL LOCATION")}
    assert ("c.s.u", "TABLE") not in picked(large)
