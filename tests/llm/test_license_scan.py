import re

import pytest

from catkeep.llm import license_scan
from catkeep.llm.license_rules import WEIGHT, Rule, all_rules
from tests.llm.helpers import documents, no_documents, odd_documents, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}
RULES = all_rules()
TEXTS = [
    "Licensed under CC BY-NC 4.0.", "cc-by cc_by CC  BY", "CC\nBY and (GENERAL) public, license!",
    "the GNU General Public License version 3. All rights reserved. All rights reserved",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
    "SPDX-License-Identifier: GPL-2.0-or-later", "https://creativecommons.org/licenses/by-sa/4.0/ xcc by", "accc by cc bye",
    "all rights\u00e9 reserved", "Copyright (c) 2020 Somebody Else Inc. All rights reserved. CC by", "\u212acc by \u017f",
    "This work is dedicated to the public domain", "BSD 3-Clause License " * 300, "mozilla.org/MPL/2.0 unlicense",
    "Permission is hereby granted, free of charge, to any person obtaining a copy",
]


def words_of(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(text, rules=RULES):
    words = words_of(text)
    line = f" {' '.join(words)} "
    places = [
        (i, label)
        for phrase, label in license_scan.BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    found = []
    for number, rule in enumerate(rules):
        for m in re.finditer(f"(?<= )({rule.pattern})(?= )", line):
            start = line[: m.start()].count(" ") - 1
            found.append((start, start + m.group().count(" ") + 1, rule.rank, number, rule.label))
    order = sorted(found, key=lambda d: (d[0], -d[1], d[2], d[3]))
    kept = [
        d for i, d in enumerate(order)
        if not any(e[0] <= d[0] and e[1] >= d[1] and e[2] <= d[2] for e in order[:i])
    ]
    base = sorted({x for _, x in places})
    return (
        len(words), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None),
        ",".join(base), ",".join(sorted({*base, *(d[4] for d in kept)})),
        max([0.0, *(WEIGHT[d[2]] for d in kept), *([WEIGHT[2]] if base else [])]),
        [(d[0], d[1], d[3], d[4]) for d in kept],
    )


def check(frame, rules=None):
    for r in license_scan.scan(frame, rules).collect():
        got = (
            r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"],
            [tuple(d) for d in r["detections"]],
        )
        assert got == brute(r["text"], rules or RULES), r["text"][:80] if r["text"] else r["text"]


def test_phrases(spark):
    check(documents(spark, TEXTS))
    [r] = license_scan.scan(documents(spark, TEXTS[:1])).collect()
    assert (r["base_labels"], r["labels"]) == ("cc-by", "cc-by,cc-by-nc-4.0")


def test_whole_table(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))


def test_odd_rows(spark):
    frame = odd_documents(spark, labels="clash", score="clash")
    check(frame)
    assert license_scan.scan(frame).count() == frame.count()
    assert license_scan.scan(no_documents(spark)).count() == 0


def shortest(pattern):
    """A text that the pattern matches: first branches, fewest repeats."""

    def of(parsed):
        out = ""
        for kind, value in parsed:
            name = str(kind)
            if name == "LITERAL":
                out += chr(value)
            elif name == "IN":
                first = value[0]
                out += chr(first[1]) if str(first[0]) == "LITERAL" else {"CATEGORY_DIGIT": "7"}.get(str(first[1]), "x")
            elif name == "BRANCH":
                out += of(value[1][0])
            elif name == "SUBPATTERN":
                out += of(value[-1])
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                out += of(value[2]) * value[0]
            else:
                raise AssertionError(name)
        return out

    return of(re._parser.parse(pattern))


def test_hundreds_of_rules_are_reached_through_marks_and_keywords(spark):
    assert len(RULES) > 250
    texts = [shortest(rule.pattern) for rule in RULES]
    found = {r["doc_id"]: r for r in license_scan.scan(documents(spark, texts)).collect()}
    for i, rule in enumerate(RULES):
        assert re.fullmatch(rule.pattern, texts[i])
        assert found[i]["detections"], (rule, texts[i])


def every_branch(pattern):
    """Texts that the pattern matches; each branch, letter of a class and number of repeats is in one at least."""

    def of(parsed):
        parts = [of_one(str(kind), value) for kind, value in parsed]
        first = [p[0] for p in parts]
        return ["".join(first)] + [
            "".join([*first[:i], other, *first[i + 1 :]]) for i, p in enumerate(parts) for other in p[1:]
        ]

    def of_one(name, value):
        if name == "LITERAL":
            return [chr(value)]
        if name == "IN":
            letters = [chr(v) for kind, v in value if str(kind) == "LITERAL"]
            return letters or ["7" if str(value[0][1]) == "CATEGORY_DIGIT" else "x"]
        if name == "BRANCH":
            return [x for branch in value[1] for x in of(branch)]
        if name == "SUBPATTERN":
            return of(value[-1])
        assert name in ("MAX_REPEAT", "MIN_REPEAT"), name
        least, most, inner = value
        return [x * n for n in dict.fromkeys((least, min(most, least + 1))) for x in (of(inner) if n else [""])]

    return list(dict.fromkeys(of(re._parser.parse(pattern))))


def test_every_branch_of_every_rule_is_reached(spark):
    cases = [(rule, text) for rule in RULES for text in every_branch(rule.pattern)]
    assert len(cases) > 3 * len(RULES)
    for rule, text in cases:
        assert re.fullmatch(rule.pattern, text)
        assert rule.keyword in f" {text} ", (rule, text)
    texts = sorted({text for _, text in cases})
    for r in license_scan.scan(documents(spark, texts).repartition(8)).collect():
        assert r["detections"], r["text"]


def test_warranties_without_the_singular(spark):
    frame = documents(spark, ["Sold without warranties of any kind.", "without WARRANTY of any kind"])
    check(frame)
    assert [(r["labels"], r["score"]) for r in license_scan.scan(frame).collect()] == [("no-warranty", 0.4)] * 2


@pytest.mark.parametrize(
    ("text", "labels"),
    [("b b b", "low"), ("a b b", "high"), ("a b b c", "long")],
)
def test_suppression(spark, text, labels):
    rules = [Rule("b", 2, "low", "b b"), Rule("a", 1, "high", "a b b"), Rule("c", 1, "long", "a b b c"), Rule("c", 2, "c", "c")]
    marked = documents(spark, [f"{text} licensed"])
    check(marked, rules)
    assert license_scan.scan(marked, rules).collect()[0]["labels"] == labels


def test_native_plan(spark):
    plan = license_scan.scan(documents(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_very_many_detections_in_one_text(spark):
    """Every place counts, and the fold's pieces carry the ends on to the next one."""
    notice = "BSD 3-Clause License. All rights reserved. "
    few, many = (
        license_scan.scan(documents(spark, [notice * n])).collect()[0] for n in (3, 32_000)
    )
    each = len(few["detections"]) // 3
    assert each and len(many["detections"]) == 32_000 * each
    assert (many["labels"], many["score"], many["n_base"]) == (few["labels"], few["score"], 32_000)
    width = few["n_words"] // 3
    shifted = {(d["start"] % width, d["end"] - d["start"], d["rule"]) for d in many["detections"]}
    assert shifted == {(d["start"] % width, d["end"] - d["start"], d["rule"]) for d in few["detections"]}
