"""Outcome rows of a restore, and the reports made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep import model
from catkeep.operators.ordering import newest_per_key
from catkeep.session import shuffles_freed

#: Bits of the filter that a report puts on the inventory: 512 KB; it lets few objects through that
#: the log does not name up to half a million of those it does, and more and more beyond.
FILTER_BITS = 1 << 22


def record_outcomes(selected: DataFrame, failures: DataFrame) -> DataFrame:
    """(object_uid, error_message, status) for all object types in one pass.

    Failures are rows (object_uid, error_message); every other selected row succeeded.
    """
    failed_ids = failures.select("object_uid").distinct()
    succeeded = selected.select("object_uid").join(failed_ids, "object_uid", "left_anti")
    return succeeded.select(
        "object_uid",
        F.lit(None).cast("string").alias("error_message"),
        F.lit(model.SUCCEEDED).alias("status"),
    ).unionByName(
        failures.select("object_uid", "error_message", F.lit(model.FAILED).alias("status"))
    )


def with_fallback_flag(outcomes: DataFrame, used_fallback: DataFrame) -> DataFrame:
    """Mark the successes that needed the short statement; ``used_fallback`` holds their uids."""
    marked = used_fallback.select("object_uid").distinct().withColumn("_short", F.lit(True))
    return (
        outcomes.join(marked, "object_uid", "left")
        .withColumn(
            "used_fallback",
            F.coalesce(F.col("_short") & (F.col("status") == model.SUCCEEDED), F.lit(False)),
        )
        .drop("_short")
    )


def checkpoint_rows(outcomes: DataFrame, job_id: int, at: Column) -> DataFrame:
    return outcomes.select(
        F.lit(job_id).cast("long").alias("jobid"),
        F.col("object_uid").alias("rowid"),
        "status",
        "error_message",
        at.alias("record_timestamp"),
    )


def append_checkpoints(outcomes: DataFrame, path: str, job_id: int, batch: str, at: Column) -> None:
    """Put the outcomes of one batch of a job into the log.

    The log has a directory per job and batch. A batch that is written again, as by a driver that died and
    started anew, replaces what it had written, so no row is doubled; other batches stay.
    """
    rows = checkpoint_rows(outcomes, job_id, at).withColumn("batch", F.lit(batch))
    with shuffles_freed(outcomes.sparkSession):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("jobid", "batch")
            .parquet(path)
        )


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    """The log; a filter on the job reads that job's directories only."""
    stored = spark.read.schema(model.CHECKPOINT_SCHEMA).option("recursiveFileLookup", "false").parquet(path)
    return stored.select(*model.CHECKPOINT_SCHEMA.fieldNames())


def of_job(checkpoints: DataFrame, job_id: int) -> DataFrame:
    return checkpoints.filter(F.col("jobid") == job_id)


def latest_status(log: DataFrame) -> DataFrame:
    """The newest log row per object; equal times are settled by status."""
    return newest_per_key(log, "rowid", [F.desc("record_timestamp"), F.asc("status")])


def id_filter(ids: DataFrame, column: str, bits: int = FILTER_BITS) -> Column:
    """Whether a key may be among ``ids``: a Bloom filter of a fixed size, as a scalar sub-query.

    Each id sets two bits of ``bits``; every word of the filter is there, so that it is an array to look up in.
    """
    words = bits // 64
    hashes = [F.xxhash64("_id"), F.xxhash64(F.lit(1), "_id")]
    place = F.explode(F.array(*[F.pmod(h, F.lit(bits)) for h in hashes]))
    set_bits = (
        ids.select(F.col(column).alias("_id")).filter("_id IS NOT NULL").select(place.alias("_place"))
        .select(F.floor(F.col("_place") / 64).alias("_word"), F.expr("shiftleft(1L, int(_place % 64))").alias("_bits"))
    )
    every = ids.sparkSession.range(words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
    folded = set_bits.unionByName(every).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
    held = folded.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_word", "_bits"))), lambda w: w["_bits"])
    ).scalar()

    def has(key: Column) -> Column:
        at = F.pmod(key, F.lit(bits))
        word = F.get(held, F.floor(at / 64).cast("int"))
        return F.getbit(word, (at % 64).cast("int")) == 1

    return has(F.xxhash64(column)) & has(F.xxhash64(F.lit(1), column))


def _objects(inventory: DataFrame, columns: list[str], log: DataFrame) -> DataFrame:
    """Inventory objects by id, without most of those that the log does not name.

    An inventory holds every id once: snapshots are checked for repeats when they are committed.
    The filter sits on the scan, so statements of other objects are not shuffled.
    """
    objects = inventory.select(F.col("object_uid").alias("rowid"), *columns)
    return objects.filter(F.col("rowid").isNotNull() & id_filter(log, "rowid"))


REPORT_COLUMNS = [
    "jobid", "rowid", "status", "error_message", "object_name", "object_type",
    "object_parent_name", "object_parent_type", "record_timestamp", "restore_ddl",
    "api_payload", "created_tsp",
]


def detailed_report(log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every log row with its object; log rows of unknown objects stay."""
    about = [
        "object_name", "object_type", "object_parent_name", "object_parent_type",
        "restore_ddl", "api_payload", "created_tsp",
    ]
    return log.join(_objects(inventory, about, log), "rowid", "left").select(*REPORT_COLUMNS)


def status_summary(log: DataFrame) -> DataFrame:
    return (
        latest_status(log)
        .groupBy("jobid", "status")
        .agg(
            F.count("status").alias("total_count"),
            F.max("record_timestamp").alias("record_timestamp"),
        )
    )


def report_rank() -> Column:
    """1-based place of a report line, by its type or its parent's type."""
    rank = F.lit(len(model.REPORT_ORDER) + 1)
    for place in range(len(model.REPORT_ORDER), 0, -1):
        name = model.REPORT_ORDER[place - 1]
        hit = (F.col("object_type") == name) | (F.col("object_parent_type") == name)
        rank = F.when(hit, place).otherwise(rank)
    return rank


def report_by_type(log: DataFrame, inventory: DataFrame) -> DataFrame:
    """Latest status counted per object kind, in dependency order."""
    objects = _objects(inventory, ["object_type", "object_parent_type"], log)
    return (
        latest_status(log)
        .join(objects, "rowid", "left")
        .groupBy("jobid", "object_type", "object_parent_type", "status")
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.max("record_timestamp").alias("record_timestamp"),
        )
        .withColumn("report_rank", report_rank())
        .orderBy("report_rank")
    )


def failed_only(report: DataFrame) -> DataFrame:
    return report.filter(F.col("status") == model.FAILED)
