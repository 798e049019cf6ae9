"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Used where no folder is configured and the executors are threads of the driver.
LOCAL_FOLDER = "/tmp/checkpoints/catkeep"
#: Whether the shuffle files of a query are deleted when it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName("catkeep")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    A cluster must configure one. Only with a ``local`` master, where driver and executors are one
    process, a local folder stands in for it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or LOCAL_FOLDER)
    return context.getCheckpointDir()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query run within has shuffled is deleted when it ends, and not only when the driver's memory is cleared.

    For writes, and other queries whose DataFrame is not run a second time.
    """
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete what a path or pattern names, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in system.globStatus(place) or []:
        system.delete(found.getPath(), True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else writes to, below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
