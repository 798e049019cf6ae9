import datetime as dt

from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators import audit, jobs, outcomes
from catkeep.sources import reports

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 6, 1)


def hours(n):
    return T0 + dt.timedelta(hours=n)


def job_log(spark):
    rows = [
        (1, "Restore", "Succeeded", T0, hours(1), 3),
        (2, "Restore", "Running", hours(5), None, 4),
        (1, "Other", "Failed", hours(9), hours(10), 4),
        (4, "Done", "Completed", hours(9), hours(10), 4),
    ]
    return spark.createDataFrame(
        rows, "jobid long, jobtype string, jobstatus string, jobstart timestamp_ntz, jobend timestamp_ntz, backupversion int"
    )


def state(df):
    return {(r.jobtype, r.jobid): (r.jobstatus, r.jobend) for r in df.collect()}


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def test_max_job_id(spark):
    log = job_log(spark)
    assert tuple(jobs.max_job_id(log, "Restore").first()) == (2, "Running")
    assert tuple(jobs.max_job_id(log, "None").first()) == (0, None)


def test_update_status(spark):
    log = job_log(spark)
    before = state(log)
    closed = state(jobs.update_status(log, "Restore", model.COMPLETED, now()))
    assert closed == before | {("Restore", 2): ("Completed", NOW)}
    assert state(jobs.update_status(log, "Done", model.COMPLETED, now())) == before
    reopened = state(jobs.update_status(log, "Other", model.RUNNING, now()))
    assert reopened == before | {("Other", 1): ("Running", hours(10))}
    assert state(jobs.update_status(log, "Done", model.RUNNING, now()))[("Done", 4)][0] == "Running"
    assert state(jobs.update_status(log, "Nobody", model.COMPLETED, now())) == before


def test_next_run(spark):
    log = job_log(spark)
    before = state(log)
    types = spark.createDataFrame([("Restore",), ("Other",), ("Done",), ("New",), ("New",)], "jobtype string")
    fresh = jobs.next_run(log, types, model.FRESH_START, now(), 7)
    assert state(fresh) == before | {
        ("Restore", 2): ("Completed", NOW), ("Other", 1): ("Completed", NOW),
        ("Restore", 3): ("Running", None), ("Other", 2): ("Running", None),
        ("Done", 5): ("Running", None), ("New", 1): ("Running", None),
    }
    assert fresh.count() == 8
    again = jobs.next_run(log, types, "RESTART", now(), 7)
    assert state(again) == before | {
        ("Other", 1): ("Running", hours(10)), ("Done", 5): ("Running", None), ("New", 1): ("Running", None),
    }
    # Types that are not asked for stay as they are.
    only = jobs.next_run(log, types.filter("jobtype = 'New'"), model.FRESH_START, now(), 7)
    assert state(only) == before | {("New", 1): ("Running", None)}


def objects(spark):
    rows = [(1, "t1", "TABLE", "SCHEMA"), (1, "t1", "TABLE", "SCHEMA"), (2, "o", "OWNER", "TABLE"), (None, "n", "VIEW", "SCHEMA")]
    df = spark.createDataFrame(rows, "object_uid long, object_name string, object_type string, object_parent_type string")
    return df.withColumns(
        {"object_parent_name": F.lit("p"), "restore_ddl": F.lit("d"), "api_payload": F.lit(None).cast("string"),
         "created_tsp": F.lit(T0).cast("timestamp_ntz")}
    )


def log(spark):
    rows = [
        (2, 1, "Failed", 'a "quoted",\ntext', hours(1)),
        (2, 1, "Succeeded", None, hours(2)),
        (2, 2, "Failed", "x", hours(3)),
        (2, 9, "Succeeded", None, hours(3)),
        (3, 1, "Failed", "later job", hours(9)),
    ]
    return spark.createDataFrame(
        rows, "jobid long, rowid long, status string, error_message string, record_timestamp timestamp_ntz"
    )


def test_reports(spark, tmp_path):
    mine = outcomes.of_job(log(spark), 2)
    inventory = objects(spark).dropDuplicates(["object_uid"])
    report = outcomes.detailed_report(mine, inventory)
    assert report.columns == outcomes.REPORT_COLUMNS
    assert report.count() == 4  # the unknown one stays
    assert report.filter("rowid = 9").first().object_name is None
    summary = {r.status: (r.total_count, r.record_timestamp) for r in outcomes.status_summary(mine).collect()}
    assert summary == {"Succeeded": (2, hours(3)), "Failed": (1, hours(3))}
    by_type = [(r.object_type, r.status, r.report_rank) for r in outcomes.report_by_type(mine, inventory).collect()]
    # A table is listed with its schema, its owner row with the table.
    assert set(by_type) == {("TABLE", "Succeeded", 7), ("OWNER", "Failed", 8), (None, "Succeeded", 12)}
    reports.write_csv(report, str(tmp_path / "r"))
    back = reports.read_csv(spark, str(tmp_path / "r"), report.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, report.collect()))
    assert outcomes.failed_only(back).count() == 2


def test_fallback_flag(spark):
    made = spark.createDataFrame([(1, "Succeeded"), (2, "Failed"), (3, "Succeeded")], "object_uid long, status string")
    short = spark.createDataFrame([(1,), (2,), (1,)], "object_uid long")
    got = {r.object_uid: r.used_fallback for r in outcomes.with_fallback_flag(made, short).collect()}
    assert got == {1: True, 2: False, 3: False}


def events(spark):
    rows = [
        ("createCatalog", 1, ("a", None, None)),
        ("deleteCatalog", 2, (None, "a", None)),
        ("createCatalog", 1, ("b", None, None)),
        ("updateCatalog", 5, (None, "c", None)),
        ("deleteCatalog", 4, (None, "c", None)),
        ("getCatalog", 4, (None, "system", None)),
        ("getCatalog", 4, (None, "__vendor_internal", None)),
        ("listCatalog", 4, (None, None, None)),
        ("other", 9, ("z", "z", "z")),
    ]
    data = [(hours(h), a, (*p, "ms")) for a, h, p in rows]
    return spark.createDataFrame(
        data, "event_time timestamp_ntz, action_name string, request_params struct<name:string,name_arg:string,catalog_name:string,metastore_id:string>"
    )


def test_unbound(spark):
    visible = spark.createDataFrame([("c",)], "catalog_name string")
    assert {r[0] for r in audit.unbound_catalogs(events(spark), visible.limit(0), metastore="ms").collect()} == {"b", "c", "__vendor_internal"}
    left_out = ["__vendor_internal"]
    assert {r[0] for r in audit.unbound_catalogs(events(spark), visible.limit(0), None, "ms", left_out).collect()} == {"b", "c"}
    assert {r[0] for r in audit.unbound_catalogs(events(spark), visible, metastore="ms").collect()} == {"b", "__vendor_internal"}
    assert audit.unbound_catalogs(events(spark), visible, metastore="else").isEmpty()
    inventory = spark.createDataFrame([(hours(5),)], "created_tsp timestamp_ntz")
    since = audit.look_back_start(inventory)
    assert since.first()[0] == hours(3)
    assert {r[0] for r in audit.unbound_catalogs(events(spark), visible.limit(0), since).collect()} == {"c", "__vendor_internal"}
    assert audit.look_back_start(inventory.limit(0)).first()[0] == dt.datetime(1900, 1, 1)
