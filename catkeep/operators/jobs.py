"""The job log: one row per run of each job type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep import model


def last_jobs(jobs: DataFrame) -> DataFrame:
    """Newest job id per type and its status."""
    return jobs.groupBy("jobtype").agg(
        F.max("jobid").alias("last_jobid"), F.max_by("jobstatus", "jobid").alias("last_status")
    )


def max_job_id(jobs: DataFrame, job_type: str) -> DataFrame:
    """One row: the newest id of a type, 0 without any, and its status."""
    return jobs.filter(F.col("jobtype") == job_type).agg(
        F.coalesce(F.max("jobid"), F.lit(0)).alias("max_jobid"),
        F.max_by("jobstatus", "jobid").alias("jobstatus"),
    )


def _changed(jobs: DataFrame, due: Column, status: str, ended: Column) -> DataFrame:
    """Rewrite status and end time of the due rows; re-opening a job keeps its end time."""
    end = F.col("jobend") if status == model.RUNNING else ended
    return jobs.withColumns(
        {
            "jobend": F.when(due, end).otherwise(F.col("jobend")),
            "jobstatus": F.when(due, F.lit(status)).otherwise(F.col("jobstatus")),
        }
    )


def update_status(
    jobs: DataFrame,
    job_type: str,
    status: str,
    ended: Column,
    current: list[str] = (model.RUNNING, model.FAILED),
) -> DataFrame:
    """Job log with the newest job of a type moved to a new status.

    Only a job in one of the ``current`` statuses moves, except when moving to Running.
    """
    newest = jobs.filter(F.col("jobtype") == job_type).agg(F.max("jobid"))
    due = (F.col("jobtype") == job_type) & (F.col("jobid") == newest.scalar())
    if status != model.RUNNING:
        due = due & F.col("jobstatus").isin(list(current))
    return _changed(jobs, F.coalesce(due, F.lit(False)), status, ended)


def next_run(
    jobs: DataFrame, job_types: DataFrame, restart_mode: str, now: Column, backup_version: int
) -> DataFrame:
    """Job log after opening a run of every type in ``job_types`` (one column, jobtype).

    FRESH_START completes the last open job and adds the next id. Any other mode adds one
    only if there is none or the last has finished, and re-opens the last otherwise.
    """
    last = job_types.distinct().join(last_jobs(jobs), "jobtype", "left")
    fresh = restart_mode == model.FRESH_START
    finished = F.col("last_status").isin("Succeeded", model.COMPLETED)
    starts_new = F.lit(True) if fresh else F.coalesce(finished, F.lit(True))
    plan = last.withColumn("starts_new", starts_new)

    touched = jobs.join(
        plan.select("jobtype", F.col("last_jobid").alias("jobid"), "starts_new"),
        ["jobtype", "jobid"],
        "left",
    )
    if fresh:
        due = F.col("starts_new") & F.col("jobstatus").isin(model.RUNNING, model.FAILED)
        kept = _changed(touched, F.coalesce(due, F.lit(False)), model.COMPLETED, now)
    else:
        due = F.coalesce(~F.col("starts_new"), F.lit(False))
        kept = _changed(touched, due, model.RUNNING, now)
    added = plan.filter("starts_new").select(
        (F.coalesce("last_jobid", F.lit(0)) + 1).cast("long").alias("jobid"),
        "jobtype",
        F.lit(model.RUNNING).alias("jobstatus"),
        now.alias("jobstart"),
        F.lit(None).cast("timestamp_ntz").alias("jobend"),
        F.lit(backup_version).cast("int").alias("backupversion"),
    )
    return kept.select(*model.JOB_SCHEMA.fieldNames()).unionByName(added)
