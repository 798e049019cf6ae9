"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import threading
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(column: Column | str) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(column, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


_made = threading.local()


def _paths() -> list[str]:
    """Scratch paths of this thread, oldest first."""
    return _made.__dict__.setdefault("paths", [])


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that ``discard`` knows of."""
    path = scratch_path(spark, label)
    _paths().append(path)
    return path


def scratch_count() -> int:
    return len(_paths())


def discard(spark: SparkSession, first: int = 0, last: int | None = None) -> None:
    """Delete this thread's scratch paths from ``first`` up to ``last``; nothing may read them any more."""
    gone = _paths()[first:last]
    del _paths()[first:last]
    for path in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df from a table in the shared folder: lost executors cost no recomputation."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples of Python values."""
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        yield from zip(*columns, strict=True)


def keep_but(df: DataFrame, made: Iterable[str]) -> list[Column]:
    """The columns of df that the operator's own results do not replace."""
    made = set(made)
    return [F.col(f"`{c}`") for c in df.columns if c not in made]
