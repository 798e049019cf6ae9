"""Exact deduplication as a stateful stream.

Rows are landed as a table that grows by files; a stream over it keeps, per digest and without expiry, the
row that stays, where its content lies and how many rows there are. State is in RocksDB, on disk and in
the checkpoint. Each trigger writes the states it changed. Afterwards every hit is compared, byte for
byte, with the content that its state points to; rows that only share a digest form groups by content.

Defined cases: a null text counts as empty, and all empty texts are equal; a null doc_id stays only if no
other row of its group has the same length and an id; equal rows are told apart by where they were
landed, so exactly one row of a group is kept; no rows give no rows. Input columns named like a result
column are replaced by it.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep.llm.common import keep_but, scratch, text_or_empty, written
from catkeep.llm.url_filter import broadcast_blocks, with_possible

RESULT = ("keep_id", "group_size", "kept", "text_sha256")
#: Landed files that one trigger takes.
FILES_PER_TRIGGER = 64
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Do not reserve space for files that stay small.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.metricsEnabled": "false",
}


def normalised(text: Column) -> Column:
    """Text without blanks and ASCII control white space."""
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def land(documents: DataFrame, path: str, digest: Callable[[Column], Column] = sha256) -> None:
    """Append rows to the landed table, with digest and hash of the normalised text and its length.

    The input's columns are in one struct, so that none is taken for one of the operator's own.
    """
    text = F.col("_content")
    rows = documents.select(
        F.struct(*keep_but(documents, RESULT)).alias("_input"), text_or_empty().alias("_content")
    ).withColumn("_norm", normalised(text))
    rows.select(
        "_input",
        digest(F.col("_norm")).alias("_digest"),
        sha256(F.col("_norm")).alias("_sha"),
        F.length(text).cast("long").alias("_points"),
    ).write.mode("append").option("compression", "zstd").parquet(path)


def _located(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "doc_id": F.col("_input.doc_id"), "_file": F.col("_metadata.file_name"),
            "_row": F.col("_metadata.row_index"),
        }
    )


def _rank() -> Column:
    """Least for the row that stays: most code points, then an id, then the smallest one."""
    return F.struct(
        (-F.col("_points")).alias("minus_points"),
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id"),
        F.col("_file").alias("file"),
        F.col("_row").alias("row"),
    )


def keyed_state(landed_rows: DataFrame) -> DataFrame:
    """Per digest the row that stays with its content locator, and the number of rows."""
    return landed_rows.groupBy("_digest").agg(
        F.min(_rank()).alias("_keeper"), F.count(F.lit(1)).alias("_size")
    )


def run_stream(spark: SparkSession, landed: str, schema, states: str, checkpoint: str, files: int) -> None:
    """Take in what has been landed since the last call; state survives in ``checkpoint``."""

    def sink(changed: DataFrame, batch: int) -> None:
        changed.withColumn("trigger", F.lit(batch)).write.mode("overwrite").parquet(f"{states}/trigger={batch}")

    with _settings(spark, STATE_SETTINGS):
        rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(landed)
        query = (
            keyed_state(_located(rows).select("_digest", "_points", "doc_id", "_file", "_row"))
            .writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(sink)
            .start()
        )
        query.awaitTermination()


def _latest(spark: SparkSession, states: str, schema) -> DataFrame:
    changes = spark.read.schema(schema).parquet(f"{states}/*")
    return changes.groupBy("_digest").agg(
        F.max_by(F.struct("_keeper", "_size"), "trigger").alias("state")
    ).select("_digest", "state._keeper", "state._size")


def dedup(
    documents: DataFrame,
    digest: Callable[[Column], Column] = sha256,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """All rows and columns of ``documents`` (doc_id, text) with keep_id, group_size, kept, text_sha256."""
    spark = documents.sparkSession
    landed, states, checkpoint = (
        scratch(spark, f"dedup-{x}") for x in ("landed", "states", "checkpoint")
    )
    documents = documents.withColumn("doc_id", F.col("doc_id").cast("long"))
    land(documents, landed, digest)
    rows = spark.read.parquet(landed)
    run_stream(spark, landed, rows.schema, states, checkpoint, files_per_trigger)
    rows = _located(rows)
    like = keyed_state(rows).withColumn("trigger", F.lit(0)).schema
    latest = _latest(spark, states, like) if rows.head(1) else spark.createDataFrame([], like).drop("trigger")
    shared = written(latest.where("_size > 1"), "dedup-shared")
    # Content of rows without a partner is not shuffled: a Bloom filter of the shared digests keeps nearly
    # all of it back.
    marked = with_possible(rows, shared, "_digest", broadcast_blocks(shared.count()))
    near = marked.where("possible").drop("possible").join(shared, "_digest", "left")
    near, alone = written(near, "dedup-near"), marked.where("NOT possible").drop("possible")
    odd = _collisions(near)
    matched = near
    if odd.head(1):
        apart = near.join(odd, "_digest", "left_semi").withColumn("_norm", normalised(text_or_empty("_input.text")))
        groups = apart.groupBy("_norm").agg(F.min(_rank()).alias("_keeper"), F.count(F.lit(1)).alias("_size"))
        apart = apart.drop("_keeper", "_size").join(groups, "_norm").drop("_norm")
        matched = near.join(odd, "_digest", "left_anti").unionByName(apart)
    return _result(matched.unionByName(alone, allowMissingColumns=True))


def _collisions(near: DataFrame) -> DataFrame:
    """Digests of different contents: the full content of every hit is compared with its keeper's."""
    hits = near.where("_size > 1").select(
        "_digest", normalised(text_or_empty("_input.text")).alias("_norm"), _stays().alias("_first")
    )
    keepers = hits.where("_first").select("_digest", F.col("_norm").alias("_kept_norm"))
    differing = hits.where("NOT _first").join(keepers, "_digest").where("_norm <> _kept_norm").select("_digest")
    # Dealt anew: else the layout of the join would be kept, with all hits of a common digest in one task.
    return written(differing.repartition(F.xxhash64("_digest")).distinct(), "dedup-collisions")


def _stays() -> Column:
    return (F.col("_file") == F.col("_keeper.file")) & (F.col("_row") == F.col("_keeper.row"))


def _result(matched: DataFrame) -> DataFrame:
    """The input's columns and the results; rows without a state of their own are alone."""
    alone = F.col("_size").isNull()
    return matched.select(
        "_input.*",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keeper.doc_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | _stays()).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"),
    )
