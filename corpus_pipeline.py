"""A corpus from raw documents to packed sequences, in stages that each read what the last one wrote."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from catkeep.llm import bagminhash, exact_dedup, packing, toxicity
from catkeep.llm.common import discard
from catkeep.llm.queries import pieces_digest, table
from catkeep.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stage(function: Stage) -> Stage:
    """A stage whose input is a stored table deletes what the stages before it, in this thread, had left.

    Their results have been written by then, so nothing reads those tables any more.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if docs.inputFiles():
            discard(spark)
        return function(spark, docs, sf_dir)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones among them, does not reject."""
    net = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, net).where("predicted = 0").select(*docs.columns)


@stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.dedup(docs).where("kept").select(*docs.columns)


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates."""
    return bagminhash.near_duplicates(docs).where("kept").select(*docs.columns)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 2048 tokens."""
    return pieces_digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack_sequences),
]

#: SQL can express neither the model nor the signatures; tests check the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        # The next stage deletes scratch tables; its input is none of them.
        path = scratch_path(spark, f"stage-{name}")
        result = function(spark, docs, sf_dir)
        result.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
