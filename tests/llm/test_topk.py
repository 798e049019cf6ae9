import math

import numpy as np
from pyspark.sql import functions as F

from catkeep.llm import topk

VECTORS = "vec_id long, embedding array<double>"


def brute(rows, k, every):
    good = [
        (i, [math.floor(64 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, rows, k=5, every=3, **options):
    frame = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("clash")).repartition(3)
    found = topk.top_k(frame, F.col("vec_id") % every == 0, k, **options).collect()
    assert sorted(map(tuple, found)) == brute(rows, k, every)


def test_clustered_vectors_in_small_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) + 5 * (i % 2)).tolist()) for i in range(300)]
    check(spark, rows, block_rows=64, query_rows=16, groups=3)


def test_ties_and_repeats(spark):
    rows = [(i, [float(i % 2), 0.0]) for i in range(80)] + [(1, [1.0, 0.0])] * 3
    check(spark, rows, block_rows=20, groups=2)


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (3, None), (6, [math.nan, 1.0]), (9, [math.inf, 1.0]), (12, [None, 1.0]), (15, []),
        (18, [0.0, 0.0]), (None, [1.0, 1.0]), (1, [1.0]), (2, [1.0, 2.0, 3.0]), (4, [-1e12, 3.0]), (5, [-0.001, 0.0]),
    ]
    check(spark, rows)
    check(spark, rows, block_rows=2, groups=2)


def test_few_and_none(spark):
    check(spark, [(0, [1.0])])
    check(spark, [])


def test_reading_stops_when_the_bound_cannot_win():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-9, 10, (4000, 3))
    vectors[:40] += 60
    lists = np.argsort(-vectors, axis=0, kind="stable").astype(np.int32).T
    block = topk.Candidates(3, np.arange(4000).tobytes(), vectors.tobytes(), np.ascontiguousarray(lists).tobytes())
    best = [topk.Best(20)]
    scored = topk.threshold_search(np.array([-1]), np.array([[5, 4, 3]]), block, best)
    assert scored < 400
    assert best[0].scores.tolist() == sorted((vectors @ [5, 4, 3]).tolist())[::-1][:20]


def test_only_rows_seen_in_the_lists_are_scored_in_many_dimensions():
    rng = np.random.default_rng(3)
    for n in (500, 4096):
        vectors = np.outer(rng.permutation(n), np.full(64, 5)) + rng.integers(-9, 10, (n, 64))
        lists = np.ascontiguousarray(np.argsort(-vectors, axis=0, kind="stable").astype(np.int32).T)
        block = topk.Candidates(64, np.arange(n).tobytes(), vectors.tobytes(), lists.tobytes())
        query, best = rng.integers(1, 9, 64), [topk.Best(20)]
        scored = topk.threshold_search(np.array([-1]), query[None], block, best)
        assert scored < 100
        assert best[0].scores.tolist() == sorted((vectors @ query).tolist())[::-1][:20]


def test_groups_are_bounded_in_bytes(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)]
    frame = spark.createDataFrame([(i, [int(64 * x) for x in v]) for i, v in rows], "vec_id long, v array<long>")
    blocks = topk.pack_blocks(frame.repartition(3), 10, True).cache()
    size = 10 * (8 + 4 * 12)
    for least, most_bytes, expected in ((2, 4 * size, 4), (24, 1 << 30, 24), (2, 1, 1), (1000, 1 << 30, 1)):
        grouped, groups = topk.in_groups(blocks, least, most_bytes)
        counts = {r["group"]: r["count"] for r in grouped.groupBy("group").count().collect()}
        assert sum(counts.values()) == blocks.count() and set(counts) == set(range(groups))
        assert groups >= min(least, blocks.count())
        assert max(counts.values()) <= max(expected, 1)
    check(spark, rows, block_rows=10, query_rows=16, groups=2, group_bytes=4 * size)
    whole = topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") < 9, 5, block_rows=10)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan


def packed(spark, rows, size):
    frame = spark.createDataFrame(rows, "vec_id long, v array<long>").coalesce(1)
    return topk.pack_blocks(frame, size, True).orderBy("block").collect()


def test_queries_of_a_block_read_the_lists_together(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, [int(x) for x in rng.integers(-64, 65, 64)]) for i in range(2500)]
    reads, seen = [], topk.Candidates.seen
    monkeypatch.setattr(topk.Candidates, "seen", lambda *a: reads.append(1) or seen(*a))
    vectors = np.array([v for _, v in rows])
    ids, asked, best = np.arange(0, 2500, 5), vectors[::5], [topk.Best(20) for _ in range(500)]
    blocks = packed(spark, rows, 1000)
    assert [len(b["ids"]) for b in blocks] == [8000, 8000, 4000]
    for b in blocks:
        assert len(b["vectors"]) == len(b["ids"]) * 8 and len(b["lists"]) == len(b["ids"]) * 16
        topk.threshold_search(ids, asked, topk.Candidates(b["dims"], b["ids"], b["vectors"], b["lists"]), best)
    assert len(reads) <= 15
    for i, query, found in zip(ids, asked, best, strict=True):
        scored = sorted((-s, n) for n, s in enumerate((vectors @ query).tolist()) if n != i)[:20]
        assert list(zip((-found.scores).tolist(), found.ids.tolist(), strict=True)) == scored


def test_queries_stop_one_by_one(spark):
    # The queries of one half find their best in the first rows, the others read on.
    rng = np.random.default_rng(6)
    vectors = rng.integers(-9, 10, (3000, 3))
    vectors[:40] += 200
    blocks = packed(spark, list(enumerate(vectors.tolist())), 3000)
    asked = np.concatenate([rng.integers(1, 9, (20, 3)), rng.integers(-9, 0, (20, 3))])
    best = [topk.Best(20) for _ in asked]
    scored = topk.threshold_search(-1 - np.arange(40), asked, topk.Candidates(*blocks[0][1:]), best)
    assert scored < 40 * 3000
    for query, found in zip(asked, best, strict=True):
        expected = sorted((-s, n) for n, s in enumerate((vectors @ query).tolist()))[:20]
        assert list(zip((-found.scores).tolist(), found.ids.tolist(), strict=True)) == expected


def test_many_copies_and_wide_numbers(spark):
    # One vector many times over; numbers beyond floats, and beyond what doubles add up exactly.
    rng = np.random.default_rng(7)
    for scale in (1, 300, 1 << 22, 1 << 25):
        rows = [(i, [int(x) * scale + (i > 400) for x in rng.integers(-9, 10, 5)]) for i in range(500)]
        rows = [(i, [3 * scale] * 5 if 50 < i < 350 else v) for i, v in rows] + [(21, [9 * scale] * 5)] * 30
        check(spark, [(i, [x / 64 for x in v]) for i, v in rows], 20, 20, block_rows=128, query_rows=16, groups=2)


def test_rows_without_components(spark):
    check(spark, [(i, []) for i in range(9)] + [(i, [0.5]) for i in range(9, 12)], 4, block_rows=2)
    check(spark, [(i, []) for i in range(9)], 4)
