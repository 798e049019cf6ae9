"""Removal of lines that are spread over many sites.

Each line hash gets a HyperLogLog sketch of the sites it occurs on; sketches are built where the lines
are and merged by aggregation, so a line that is everywhere costs one row per task. Lines whose estimate
is clear are decided by it; those near the threshold are counted exactly.

Defined cases: lines are split at ``\\n`` and compared without surrounding blanks; blank lines are never
boilerplate; a null text is empty, with one blank line; a null site is no site; repeated rows count once
per site and are cleaned each on its own; no rows give no rows. Input columns named like a result column
are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import keep_but, text_or_empty, written

RESULT = ("text", "n_lines", "n_removed")
#: A line on so many sites is boilerplate.
MIN_SITES = 10
LG_K = 11
#: An estimate within so many standard errors of the threshold is counted exactly.
ERRORS = 6


def line_key(line: Column) -> Column:
    """96 bits of the line."""
    return F.struct(F.xxhash64(line).alias("a"), F.hash(line).alias("b"))


def line_rows(documents: DataFrame) -> DataFrame:
    """_row, position, key and site of every line that is not blank."""
    return (
        documents.select("_row", "_site", F.posexplode(F.split("_text", "\n", -1)).alias("pos", "line"))
        .withColumn("line", F.trim("line"))
        .where("line <> ''")
        .select("_row", "pos", line_key(F.col("line")).alias("key"), F.col("_site").alias("site"))
    )


def near_margin(min_sites: int, lg_k: int = LG_K) -> float:
    return max(1.0, ERRORS * 1.04 / 2 ** (lg_k / 2) * min_sites)


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """Keys of the lines found on at least ``min_sites`` sites."""
    margin = near_margin(min_sites, lg_k)
    estimates = lines.groupBy("key").agg(F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch")).select(
        "key", F.hll_sketch_estimate("sketch").alias("sites")
    ).where(F.col("sites") >= min_sites - margin)
    estimates = written(estimates, "line-estimates")
    clear = estimates.where(F.col("sites") > min_sites + margin).select("key")
    near = estimates.where(F.col("sites") <= min_sites + margin).select("key")
    # Distinct before the join: then a key has a row per site there, not one per occurrence.
    exact = (
        lines.where("site IS NOT NULL")
        .select("key", "site")
        .distinct()
        .join(near, "key", "left_semi")
        .groupBy("key")
        .count()
        .where(F.col("count") >= min_sites)
        .select("key")
    )
    return clear.unionByName(exact)


def remove_spread_lines(
    documents: DataFrame, site: str = "source", min_sites: int = MIN_SITES, lg_k: int = LG_K
) -> DataFrame:
    """All rows of ``documents`` with the cleaned text, the number of lines and of those removed."""
    rows = written(
        documents.select(
            F.struct(*keep_but(documents, RESULT)).alias("_input"),
            text_or_empty().alias("_text"),
            F.col(f"`{site}`").cast("string").alias("_site"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "line-documents",
    )
    lines = written(line_rows(rows), "lines")
    spread = written(spread_lines(lines, min_sites, lg_k), "spread-lines")
    removed = (
        lines.join(spread, "key", "left_semi").groupBy("_row").agg(F.collect_list("pos").alias("_removed"))
    )
    parts = F.split("_text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_removed"))
    cleaned = F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")
    return (
        rows.join(removed, "_row", "left")
        .select(
            "_input.*",
            F.when(F.col("_removed").isNull(), F.col("_text")).otherwise(cleaned).alias("text"),
            F.size(parts).cast("long").alias("n_lines"),
            F.coalesce(F.size("_removed"), F.lit(0)).cast("long").alias("n_removed"),
        )
    )
