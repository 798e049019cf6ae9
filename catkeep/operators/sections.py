"""Labelled description lines of functions, parsed as ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catkeep.functions import render

# --- fixed values: labels a description line can start with ------------------------
LABELS = ["function", "type", "input", "returns", "comment", "body", "deterministic", "language"]
LABEL_PATTERN = "(?i)^(" + "|".join(LABELS) + "):"

# Lines numbered together; state is carried from one run of lines to the next.
RUN = 1_000


def running_marks(rows: DataFrame, key: str, marks: dict[str, Column], run: int | None) -> DataFrame:
    """Add, per mark, the largest ``ord`` up to the row at which the mark's condition held.

    The running maximum is taken inside runs of ``run`` lines and carried over from the
    maxima of earlier runs, so no description has to fit one task. Without ``run`` it is one
    window per description: a single shuffle, for what brings descriptions together anyway.

    There may be as many carried maxima as descriptions, so they are merged, never broadcast: their size is
    foreseen from the files, which says nothing about generated lines. First runs have none.
    """
    if run is None:
        lines = Window.partitionBy(key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
        held = {n: F.max(F.when(condition, F.col("ord"))).over(lines) for n, condition in marks.items()}
        return rows.withColumns(held)
    numbered = rows.filter(F.col(key).isNotNull() & F.col("ord").isNotNull())
    marked = numbered.withColumn("_run", F.floor(F.col("ord") / run)).withColumns(
        {f"_at_{name}": F.when(condition, F.col("ord")) for name, condition in marks.items()}
    )
    totals = marked.groupBy(key, "_run").agg(
        *[F.max(f"_at_{name}").alias(f"_sum_{name}") for name in marks]
    )
    earlier = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        key,
        "_run",
        *[F.max(f"_sum_{name}").over(earlier).alias(f"_carry_{name}") for name in marks],
    ).filter(F.coalesce(*[f"_carry_{name}" for name in marks]).isNotNull())
    so_far = (
        Window.partitionBy(key, "_run")
        .orderBy("ord")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = marked.withColumns({f"_in_{name}": F.max(f"_at_{name}").over(so_far) for name in marks})
    helpers = [f"_{kind}_{name}" for name in marks for kind in ("at", "in", "carry")]
    return (
        local.join(carried.hint("merge"), [key, "_run"], "left")
        .withColumns({name: F.greatest(f"_in_{name}", f"_carry_{name}") for name in marks})
        .drop("_run", *helpers)
    )


def parse_sections(rows: DataFrame, run: int | None = RUN) -> DataFrame:
    """(function_name, ord, section, start, text) from (function_name, ord, function_desc).

    A line without a label continues the open parameter list: inputs stay open until the
    returns label, returns until the deterministic label, and open inputs come first. Other
    unlabelled lines belong to no section. ``start`` is the line the section began at.
    """
    description = F.col("function_desc")
    label = F.lower(F.regexp_extract(description, LABEL_PATTERN, 1))
    labelled = rows.withColumn("_label", label)
    marks = {
        "_inputs": F.col("_label") == "input",
        "_returns": F.col("_label") == "returns",
        "_fixed": F.col("_label") == "deterministic",
    }
    marked = running_marks(labelled, "function_name", marks, run)
    never = F.lit(-1)
    inputs_open = F.col("_inputs") > F.coalesce("_returns", never)
    returns_open = F.col("_returns") > F.coalesce("_fixed", never)
    section = (
        F.when(F.col("_label") != "", F.col("_label"))
        .when(inputs_open, "input")
        .when(returns_open, "returns")
    )
    text = F.when(
        F.col("_label") != "", F.substring(description, F.length("_label") + 2, F.length(description))
    ).otherwise(description)
    start = (
        F.when(section == "input", F.col("_inputs"))
        .when(section == "returns", F.col("_returns"))
        .otherwise(F.col("ord"))
    )
    return (
        marked.select(
            "function_name", "ord", section.alias("section"), start.alias("start"),
            F.trim(text).alias("text"),
        )
        .filter(F.col("section").isNotNull())
    )


def functions_described(sections: DataFrame) -> DataFrame:
    """One row per function; a repeated label replaces what the earlier one gave."""

    def single(name: str) -> Column:
        return F.max(F.when(F.col("section") == name, F.struct("ord", "text"))).getField("text")

    def lines(name: str) -> Column:
        found = F.collect_list(F.when(F.col("section") == name, F.struct("start", "ord", "text")))
        last = F.array_max(F.transform(found, lambda line: line["start"]))
        ordered = F.array_sort(F.filter(found, lambda line: line["start"] == last))
        return F.transform(ordered, lambda line: line["text"])

    return sections.groupBy("function_name").agg(
        single("function").alias("described_name"),
        F.coalesce(F.lower(single("type")), F.lit("scalar")).alias("kind"),
        lines("input").alias("inputs"),
        lines("returns").alias("returns"),
        F.lower(single("language")).alias("language"),
        single("comment").alias("comment"),
        single("body").alias("body"),
    )


def function_statements(rows: DataFrame) -> DataFrame:
    """(function_name, restore_ddl) from description rows; the lines of one function become one text."""
    described = functions_described(parse_sections(rows, run=None))
    return described.select(
        "function_name",
        render.function(
            F.col("described_name"), F.col("kind"), F.col("inputs"), F.col("returns"),
            F.col("language"), F.col("comment"), F.col("body"),
        ).alias("restore_ddl"),
    )
