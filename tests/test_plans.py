"""Physical plans: what is pruned, what is shuffled, what is sent around."""

import pytest
from pyspark.sql import functions as F

from catkeep.operators import outcomes, selection, timeline
from catkeep.plans import restore
from catkeep.sources import entities
from catkeep.sources.snapshots import SnapshotStore
from queries.fixtures import Fixtures


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    fx = Fixtures(spark, sf_dir)
    kept = SnapshotStore(spark, str(tmp_path_factory.mktemp("snapshots")))
    kept.commit(fx.fx_past, F.lit("2000-07-01 00:00:00").cast("timestamp_ntz"))
    kept.commit(fx.fx_inventory, F.lit("2001-07-01 00:00:00").cast("timestamp_ntz"))
    return kept


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def tree(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_selection_filters_reach_the_scan_and_nothing_is_shuffled(store):
    spec = {"metastore": {"catalog": {"asia": {"schema": {"asia.nation_2": {"table": "*"}}}}}}
    df = selection.select_by_spec(store.read(), spec).select("object_uid", "object_name")
    text = formatted(df)
    assert "PushedFilters: [Or(" in text and "EqualTo(object_parent_name,asia.nation_2)" in text
    assert "Exchange" not in text
    assert "restore_ddl" not in text.split("ReadSchema:")[1].splitlines()[0]


def test_short_key_lists_are_broadcast(store):
    spec = {"metastore": {"catalog": {"asia": "*"}}}
    df = selection.with_dependents(store.read(), spec)
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = tree(df).split("== Initial Plan ==")[0]
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_dependents_need_no_job_while_the_plan_is_built(store, spark):
    tracker = spark.sparkContext.statusTracker()
    inventory, before = store.read(), len(tracker.getJobIdsForGroup(None))
    spec = {"metastore": {"catalog": {"asia": {"schema": {"asia.nation_2": "*"}}}}}
    plan = tree(selection.with_dependents(inventory, spec))
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert plan.count("FileScan") <= 2


def test_report_shuffles_the_inventory_once(store, spark, sf_dir):
    log = outcomes.of_job(Fixtures(spark, sf_dir).fx_checkpoint, 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = tree(outcomes.detailed_report(log, store.read()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(rowid") == 2


def test_diff_is_one_shuffle_over_two_directories(store):
    df = timeline.diff_versions(store.all_versions(), 0, 1)
    text = formatted(df)
    assert text.count("hashpartitioning") == 1
    assert text.count("PartitionFilters: [isnotnull(version") == 2


def test_newest_version_is_a_pruning_subquery(store):
    text = formatted(timeline.latest(store.all_versions(), store.history()))
    assert "Subquery" in text.split("PartitionFilters:")[1].splitlines()[0]


def test_latest_status_keeps_one_row_per_task_before_the_shuffle(spark, sf_dir):
    log = outcomes.of_job(Fixtures(spark, sf_dir).fx_checkpoint, 2)
    plan = tree(outcomes.latest_status(log))
    below_exchange = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_statements_are_rendered_inside_the_engine(store, spark, sf_dir):
    done = Fixtures(spark, sf_dir).fx_checkpoint
    plan = restore.restore_plan(store.read(), {"metastore": "*"}, done, 2)
    plan.collect()
    text = tree(plan)
    assert "Python" not in text and "NestedLoop" not in text and "Cartesian" not in text


def exchanged_bytes(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()

    def sizes(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return sizes(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return sizes(plan.plan())
        own = [plan.metrics().apply("dataSize").value()] if kind == "ShuffleExchangeExec" else []
        return own + [x for i in range(plan.children().size()) for x in sizes(plan.children().apply(i))]

    return sum(sizes(df._jdf.queryExecution().executedPlan()))


def test_a_report_shuffles_few_statements_of_other_objects(spark):
    objects = spark.range(20_000).selectExpr(
        "concat('n', id) AS object_name", "'TABLE' AS object_type", "'p' AS object_parent_name",
        "'SCHEMA' AS object_parent_type", "CAST(NULL AS STRING) AS object_cross_relationship",
        "xxhash64(id) AS object_uid", "repeat(sha2(string(id), 256), 10) AS restore_ddl",
        "CAST(NULL AS STRING) AS api_payload", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS created_tsp",
    )
    log = objects.filter("pmod(object_uid, 100) = 0").selectExpr(
        "2L AS jobid", "object_uid AS rowid", "'Failed' AS status", "'e' AS error_message", "created_tsp AS record_timestamp"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = outcomes.detailed_report(log, objects)
        moved = exchanged_bytes(report)
        whole = exchanged_bytes(objects.repartition(4, "object_uid"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert report.count() == log.count() and report.filter("restore_ddl IS NULL").isEmpty()
    assert moved < 0.03 * whole


def test_a_filter_that_is_full_loses_nothing(spark):
    ids = spark.range(5000).selectExpr("xxhash64(id) AS rowid")
    assert ids.filter(outcomes.id_filter(ids, "rowid", bits=64)).count() == 5000
    others = spark.range(5000, 9000).selectExpr("xxhash64(id) AS rowid")
    assert others.filter(outcomes.id_filter(ids, "rowid", bits=1 << 20)).count() < 40
    assert others.filter(outcomes.id_filter(ids.filter("false"), "rowid")).count() == 0


def test_a_job_reads_its_own_part_of_the_log(spark, tmp_path):
    path = str(tmp_path / "log")
    made = spark.range(40).selectExpr("id AS object_uid", "CAST(NULL AS STRING) AS error_message", "'Succeeded' AS status")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp")
    for job, batch in ((1, "a"), (1, "b"), (2, "a"), (1, "a")):
        outcomes.append_checkpoints(made, path, job, batch, at)
    log = outcomes.read_checkpoints(spark, path)
    assert {r.jobid: r["count"] for r in log.groupBy("jobid").count().collect()} == {1: 80, 2: 40}
    assert "PartitionFilters: [isnotnull(jobid" in formatted(outcomes.of_job(log, 2))


def test_function_statements_are_never_broadcast(spark):
    """One text per function; joined with the functions, they would all go through the driver."""
    described = spark.range(10).selectExpr(
        "concat('c.s.f_', id) AS function_name", "explode(sequence(0, 8)) AS ord", "'Body: a' AS function_desc"
    )
    routines = spark.range(10).selectExpr("concat('c.s.f_', id) AS object_name")
    assert "Broadcast" not in tree(entities._shape_functions(routines, {"function_descriptions": described}))
