"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from catkeep.llm.common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).where("u <> v").distinct()


def _round(links: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a written table, and how many there are with a hash over all, taken while writing."""
    seen = Observation()
    table = written(
        links.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("hash")),
        "links",
    )
    return table, (seen.get["n"], seen.get["hash"])


def components(links: DataFrame) -> DataFrame:
    """node and comp (the least node of its component) for every node with a link (u, v).

    A node with very many links is no hot key: minima are formed where the links are, and its links
    are then joined with one row. Each round is a written table; the driver sees a count and a hash.
    """
    links, before = _round(links.select("u", "v").where("u <> v").distinct())
    while True:
        links, after = _round(_small_star(_large_star(links)))
        if after == before:
            break
        before = after
    tails = links.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    heads = links.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return tails.unionByName(heads)
