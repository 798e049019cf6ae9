"""Reports as CSV, and their inputs as SQL views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Quotes inside values are doubled, as spreadsheet tools expect, so that line breaks, commas
# and quotes in error messages survive the round trip; times keep their microseconds. CSV is for
# people: a file with line breaks inside values is read whole by one task, so what goes on to be
# queried is kept as Parquet.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


# --- fixed values: names the report inputs are known by in SQL ---
INVENTORY_VIEW = "backup_table"
JOBS_VIEW = "batch_job_table"
CHECKPOINTS_VIEW = "batch_job_control_table"


def register_views(inventory: DataFrame, jobs: DataFrame, checkpoints: DataFrame) -> None:
    """Make the report inputs known to SQL under their fixed names."""
    inventory.createOrReplaceTempView(INVENTORY_VIEW)
    jobs.createOrReplaceTempView(JOBS_VIEW)
    checkpoints.createOrReplaceTempView(CHECKPOINTS_VIEW)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """``single_file`` is meant for aggregated reports of a few rows."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
