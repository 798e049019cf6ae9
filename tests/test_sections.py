"""The section parser against a line-by-line reading of the same rules."""

import random

from catkeep.operators import sections

SCHEMA = "function_name string, ord int, function_desc string"


def line_by_line(lines):
    """What a reader keeping two open/closed states finds in the lines of one function."""
    found, state = [], {"input": None, "returns": None}
    for ord_, line in lines:
        label = line.split(":")[0].lower() if ":" in line else ""
        if label in sections.LABELS:
            start = ord_
            if label == "input":
                state["input"] = ord_
            elif label == "returns":
                state["input"], state["returns"] = None, ord_
            elif label == "deterministic":
                state["returns"] = None
            found.append((ord_, label, start, line.split(":", 1)[1].strip()))
        elif state["input"] is not None:
            found.append((ord_, "input", state["input"], line.strip()))
        elif state["returns"] is not None:
            found.append((ord_, "returns", state["returns"], line.strip()))
    return found


def test_random_descriptions(spark):
    dice = random.Random(7)
    texts = ["Function: f", "Type: TABLE", "INPUT: a int", "Returns: x", "Comment: n", "Body: b",
             "Deterministic: true", "language: SQL", "  plain", "more text"]
    functions = {f"f{i}": [(o, dice.choice(texts)) for o in range(dice.randint(1, 30))] for i in range(40)}
    rows = [(name, o, line) for name, lines in functions.items() for o, line in lines]
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(name, *item) for name, lines in functions.items() for item in line_by_line(lines)}
    for run in (1000, 4, None):
        got = {tuple(row) for row in sections.parse_sections(df, run=run).collect()}
        assert got == want


def test_statement_of_a_python_table_function(spark):
    lines = ["Function: c.s.f", "Type: TABLE", "Input: a INT", "  b INT", "Returns: x INT", "  y INT",
             "Comment: it's", "Deterministic: true", "junk", "Language: PYTHON", "Body: yield 1"]
    df = spark.createDataFrame([("k", i, line) for i, line in enumerate(lines)], SCHEMA)
    got = sections.function_statements(df).first()
    assert got.restore_ddl == (
        "CREATE OR REPLACE FUNCTION `c`.`s`.`f`(a INT, b INT)\nRETURNS TABLE (x INT, y INT)\n"
        "LANGUAGE python\nCOMMENT 'it''s'\nAS $$ yield 1 $$"
    )


def test_defaults_and_repeated_labels(spark):
    lines = ["Function: f", "Input: old", "Input: a", "Returns: INT", "Body: 1"]
    df = spark.createDataFrame([("k", i, line) for i, line in enumerate(lines)], SCHEMA)
    found = sections.functions_described(sections.parse_sections(df)).first()
    assert (found.kind, found.inputs, found.returns, found.language) == ("scalar", ["a"], ["INT"], None)


def test_statements_need_one_shuffle(spark):
    df = spark.createDataFrame([("f", 0, "Function: c.s.f"), ("f", 1, "Body: 1")], SCHEMA)
    plan = sections.function_statements(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_carried_lines_are_never_broadcast(spark):
    """There can be one carried row per description; what is foreseen of their size is far too small."""
    df = spark.range(10).selectExpr(
        "concat('f', id) AS function_name", "explode(sequence(0, 8)) AS ord", "'Input: a' AS function_desc"
    )
    plan = sections.parse_sections(df)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan


def test_lines_without_a_function_or_number_are_left_out(spark):
    df = spark.createDataFrame([(None, 0, "Input: a"), ("f", None, "Input: a"), ("f", 2500, "  b"), ("f", 0, "Input: a")], SCHEMA)
    got = {tuple(row) for row in sections.parse_sections(df).collect()}
    assert got == {("f", 0, "input", 0, "a"), ("f", 2500, "input", 0, "b")}
