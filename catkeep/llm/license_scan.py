"""License scan by ordered signature rules; only DataFrame functions and nothing is shuffled.

A text without any of a few marks is done after one pass. The others are brought into words, the rules
whose keyword occurs are matched, and a detection is suppressed when its words lie within those of one
of the same or a better class (of equal detections the first rule's stays). Base phrases are found on
their own and always stay.

Defined cases: a null or empty text has no words, labels ``''`` and score 0; repeated rows and null ids
are scanned row by row; texts are scanned whole. A document's detections are one array in its row, so they
take memory in proportion to its text. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import ascii_lower, keep_but, text_or_empty
from catkeep.llm.license_rules import WEIGHT, Rule, all_rules

RESULT = (
    "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections",
)
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Every rule and base phrase needs one of these in the lower-case text, or ``cc`` as a word.
MARKS = (
    "licen", "gpl", "spdx", "copyright", "reserved", "public", "creative", "opensource", "gnu",
    "permission", "warrant", "redistrib", "propriet", "eula", "prohibited", "commercial", "cc0",
    "wtfpl", "bsd", "attribution", "mariadb", "eclipse", "europa", "lppl", "mozilla", "opendata",
    "scripts", "consortium", "cecill",
)
CC = r"(?i)(?<![0-9A-Za-z\x{80}-\x{10FFFF}])cc(?![0-9A-Za-z\x{80}-\x{10FFFF}])"
START = "\x01"
#: Detections that are folded into one array at a time.
AT_ONCE = 128


def in_words(text: Column) -> Column:
    """The words of a text with one blank before and after each."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(ascii_lower(text), BETWEEN, " ")), F.lit(" "))


def bounded(pattern: Column) -> Column:
    return F.concat(F.lit("(?<= )("), pattern, F.lit(")(?= )"))


def spans(words: Column, pattern: Column) -> Column:
    """Start and end (exclusive) in words of every match, in order.

    Starts are found by marking the first word of each match; no mark occurs in words otherwise.
    """
    whole = bounded(pattern)
    marked = F.split(F.call_function("regexp_replace", words, whole, F.lit(f"{START}$1")), " ")
    starts = F.array_compact(
        F.transform(marked, lambda w, i: F.when(w.startswith(START), i - 1))
    )
    sizes = F.transform(F.regexp_extract_all(words, whole, 1), lambda m: F.size(F.split(m, " ")))
    return F.zip_with(
        starts, sizes, lambda a, n: F.struct(a.cast("int").alias("start"), (a + n).cast("int").alias("end"))
    )


def _rule_table(rules: list[Rule]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("number"), F.lit(r.keyword).alias("keyword"), F.lit(r.rank).alias("rank"),
                F.lit(r.label).alias("label"), F.lit(r.pattern).alias("pattern"),
            )
            for i, r in enumerate(rules)
        ]
    )


def _detections(words: Column, usable: Column) -> Column:
    """Matches of the usable rules, in order of place."""
    found = F.transform(
        usable,
        lambda r: F.transform(
            spans(words, r["pattern"]),
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("minus_end"), r["rank"].alias("rank"),
                r["number"].alias("number"), r["label"].alias("label"),
            ),
        ),
    )
    return F.array_sort(F.flatten(found))


def unsuppressed(detections: Column, ranks: int = len(WEIGHT), at_once: int = AT_ONCE) -> Column:
    """Detections not contained in one of the same or a better class.

    In order of start, longest first, a detection is contained in an earlier one exactly when the
    greatest end so far, among classes up to its own, reaches its end. Appending copies an array, so
    detections are folded in pieces: only a piece's own are copied for each detection.
    """
    none = F.array().cast("array<struct<start:int,minus_end:int,rank:int,number:int,label:string>>")

    def step(state: Column, d: Column) -> Column:
        end = -d["minus_end"]
        contained = F.get(state["ends"], d["rank"]) >= end
        return F.struct(
            F.when(contained, state["kept"]).otherwise(F.concat(state["kept"], F.array(d))).alias("kept"),
            F.transform(
                state["ends"], lambda e, rank: F.when(rank >= d["rank"], F.greatest(e, end)).otherwise(e)
            ).alias("ends"),
        )

    def piece(state: Column, first: Column) -> Column:
        here = F.slice(detections, first, at_once)
        begin = F.struct(none.alias("kept"), state["last"]["ends"].alias("ends"))
        return F.struct(
            F.concat(state["done"], F.array(state["last"]["kept"])).alias("done"),
            F.aggregate(here, begin, step).alias("last"),
        )

    start = F.struct(
        F.array(none).alias("done"),
        F.struct(none.alias("kept"), F.array(*[F.lit(-1)] * ranks).alias("ends")).alias("last"),
    )
    firsts = F.when(F.size(detections) > 0, F.sequence(F.lit(1), F.size(detections), F.lit(at_once)))
    return F.aggregate(
        firsts, start, piece, lambda s: F.flatten(F.concat(s["done"], F.array(s["last"]["kept"])))
    )


def _labelled(places: Column, label: str) -> Column:
    return F.transform(
        places, lambda x: F.struct(x["start"].alias("start"), F.lit(label).alias("label"))
    )


def _labels(array: Column) -> Column:
    return F.array_sort(F.array_distinct(array))


def scan(documents: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """All rows of ``documents`` (text) with base places, labels, detections and a score.

    ``detections`` holds start, end, rule number and label of what the rules found; ``score`` is the
    weight of the best class found, at least that of a title for base phrases.
    """
    rules = all_rules() if rules is None else rules
    text, words = F.col("_text"), F.col("_words")
    marked = F.rlike(text, F.lit(CC))
    for mark in reversed(MARKS):
        marked = F.contains("_low", F.lit(mark)) | marked
    keywords = F.array(*[F.lit(k) for k in sorted({r.keyword for r in rules})])
    base = [_labelled(spans(words, F.lit(phrase)), label) for phrase, label in BASE]
    # One step a column, so that none is worked out again inside the next.
    rows = (
        documents.select(F.struct(*keep_but(documents, RESULT)).alias("_input"), text_or_empty().alias("_text"))
        .withColumn("_low", F.lower("_text"))
        .withColumn("n_words", F.regexp_count(text, F.lit(WORD)).cast("long"))
        .withColumn("_words", F.when(marked, in_words(text)))
        .withColumn("_base", F.when(words.isNotNull(), F.flatten(F.array(*base))))
        .withColumn("_keywords", F.when(words.isNotNull(), F.filter(keywords, lambda k: F.contains(words, k))))
        .withColumn(
            "_usable",
            F.when(
                F.size("_keywords") > 0,
                F.filter(_rule_table(rules), lambda r: F.array_contains("_keywords", r["keyword"])),
            ),
        )
        .withColumn("_found", F.when(words.isNotNull(), _detections(words, F.col("_usable"))))
        .withColumn("_found", unsuppressed(F.col("_found")))
    )
    starts = F.transform("_base", lambda b: b["start"].cast("long"))
    base_labels = F.coalesce(F.transform("_base", lambda b: b["label"]), F.array().cast("array<string>"))
    found_labels = F.coalesce(F.transform("_found", lambda d: d["label"]), F.array().cast("array<string>"))
    weights = F.array(*[F.lit(w) for w in WEIGHT])
    best = F.array_max(F.transform("_found", lambda d: F.get(weights, d["rank"])))
    return rows.select(
        "_input.*",
        "n_words",
        F.coalesce(F.size("_base"), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(_labels(base_labels), ",").alias("base_labels"),
        F.array_join(_labels(F.concat(base_labels, found_labels)), ",").alias("labels"),
        F.greatest(
            F.coalesce(best, F.lit(0.0)), F.when(F.size(base_labels) > 0, WEIGHT[2]).otherwise(0.0)
        ).alias("score"),
        F.coalesce(
            F.transform(
                "_found",
                lambda d: F.struct(
                    d["start"].alias("start"), (-d["minus_end"]).alias("end"),
                    d["number"].alias("rule"), d["label"].alias("label"),
                ),
            ),
            F.array().cast("array<struct<start:int,end:int,rule:int,label:string>>"),
        ).alias("detections"),
    )
