from collections import defaultdict

from pyspark.sql import functions as F

from catkeep.operators.ordering import newest_per_key, overall_position, position_in_group


def test_position_in_group_over_slices(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i * 7 % 1000, i % 5, i) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, o int, t int, id int")
    got = {row.id: row.position for row in position_in_group(df, ["k"], "o", ["t", "id"], width=37).collect()}
    groups = defaultdict(list)
    for k, o, t, i in rows:
        groups[k].append((o, t, i))
    want = {item[2]: place for items in groups.values() for place, item in enumerate(sorted(items), 1)}
    assert got == want


def test_overall_position(spark):
    rows = [(f"n{i}", i % 4) for i in range(200)]
    df = spark.createDataFrame(rows, "n string, c int").repartition(7)
    placed = overall_position(df, [F.desc("c"), F.asc("n")])
    got = [(row.c, row.n) for row in sorted(placed.collect(), key=lambda row: row.position)]
    assert got == [(c, n) for n, c in sorted(rows, key=lambda row: (-row[1], row[0]))]
    assert sorted(row.position for row in placed.collect()) == list(range(1, 201))


def test_newest_per_key_settles_ties(spark):
    rows = [(1, 5, "b"), (1, 5, "a"), (1, 4, "c"), (None, 1, "z")]
    df = spark.createDataFrame(rows, "k int, t int, s string")
    newest = newest_per_key(df, "k", [F.desc("t"), F.asc("s")])
    assert {tuple(row) for row in newest.collect()} == {(1, 5, "a"), (None, 1, "z")}
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()
