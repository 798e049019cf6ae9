from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catkeep.llm import bagminhash as bag
from catkeep.llm import url_filter
from catkeep.llm.components import components
from tests.llm.helpers import documents, no_documents, odd_documents, read_without_shuffle, table


def shingles(text):
    words = bag.WORD.findall((text or "").lower())
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def jaccard(a, b):
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


def classes(texts, threshold=0.8):
    """Components of all pairs, as sets of positions."""
    bags = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if bags[i] and bags[j] and jaccard(bags[i], bags[j]) >= threshold:
                parent[root(i)] = root(j)
    return sorted(sorted(i for i in range(len(texts)) if root(i) == r) for r in {root(i) for i in range(len(texts))})


def check(frame):
    rows = frame.collect()
    found = bag.near_duplicates(frame).collect()
    assert len(found) == len(rows)
    groups = {}
    for r in found:
        groups.setdefault(r["class_id"], []).append(r["doc_id"])
        assert r["kept"] == (r["doc_id"] == r["class_id"])
    ids = [r["doc_id"] for r in rows]
    want = sorted(sorted(ids[i] for i in c) for c in classes([r["text"] for r in rows]))
    assert sorted(map(sorted, groups.values())) == want
    for r in found:
        assert r["class_size"] == len(groups[r["class_id"]])


def test_whole_table(spark, sf_dir):
    check(table(spark, sf_dir, "documents"))


def test_chain_of_edits_in_one_bucket(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in rng.integers(0, 5000, 300)]
    texts = []
    for n in range(60):
        copy = list(words)
        for p in rng.integers(0, 300, 7 if n < 30 else 16):
            copy[p] = f"n{n}x{p}"
        texts.append(" ".join(copy))
        if n % 10 == 0:
            words[n] = "moved"
    check(documents(spark, texts).repartition(4))


def test_large_buckets_are_split_without_losing_links(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for n in range(80):
        copy = list(base)
        for p in rng.choice(200, 9, replace=False):
            copy[p] = f"n{n % 20}x{p}"
        texts.append(" ".join(copy))
    frame = documents(spark, texts)
    signed = bag.sign(frame, bag.SIZE, 5)
    small = bag.linked_nodes(signed, bag.BANDS, 0.8, bag.LEAST_ESTIMATE, 5, block_nodes=4)
    whole = bag.linked_nodes(signed, bag.BANDS, 0.8, bag.LEAST_ESTIMATE, 5)
    key = lambda r: (bytes(r["node"]), bytes(r["comp"]))
    assert sorted(map(key, small.collect())) == sorted(map(key, whole.collect()))
    dealt = bag.linked_nodes(signed, bag.BANDS, 0.8, bag.LEAST_ESTIMATE, 5, block_nodes=4, most_blocks=1)
    assert sorted(map(key, dealt.collect())) == sorted(map(key, whole.collect()))
    check(frame)


def test_hub_of_unlike_nodes_is_split(spark):
    """Nodes that have one band in common, and little else, are not compared all with all."""
    rng = np.random.default_rng(6)
    nodes, size = 600, bag.SIZE
    sigs = rng.integers(0, 1 << 16, (nodes, size)).astype(np.uint16)
    sigs[:, : bag.ROWS] = 7
    # Two pairs are near each other: nine components in ten agree.
    for a, b in ((0, 1), (2, 599)):
        sigs[b] = np.where(rng.random(size) < 0.9, sigs[a], sigs[b])
    rows = [(b"h", b"%04d" % i, b"%04d" % i, 100, sigs[i].tobytes()) for i in range(nodes)]
    all_of = spark.createDataFrame(
        [tuple(bytearray(x) if isinstance(x, bytes) else x for x in r) for r in rows],
        "hub binary, node binary, comp binary, weight long, sig binary",
    )
    around, comp = all_of.select("hub", "node"), all_of.drop("hub")
    whole = bag.split_hubs(around, comp, bag.BANDS, 16, bag.BLOCK_WORDS, most_blocks=100)
    dealt = bag.split_hubs(around, comp, bag.BANDS, 16, bag.BLOCK_WORDS, most_blocks=4)
    assert whole.count() == nodes

    def compared(members):
        pairs = bag._block_pairs(members, 16, bag.BLOCK_WORDS).selectExpr("size(nodes) + size(others) AS n")
        return pairs.groupBy().sum("n").first()[0] or 0

    def likely(members):
        tasks = bag._tasks(bag._block_pairs(members, 16, bag.BLOCK_WORDS), 0.8, bag.LEAST_ESTIMATE).collect()
        return {
            tuple(sorted((bytes(t["nodes"][u]), bytes(t["nodes"][v]))))
            for t in tasks for u, v in zip(t["us"], t["vs"], strict=True)
        }

    assert compared(dealt) * 20 < compared(whole)
    assert likely(dealt) == likely(whole) == {(b"0000", b"0001"), (b"0002", b"0599")}


def test_odd_rows(spark):
    frame = odd_documents(spark, kept="clash", class_id="clash")
    found = bag.near_duplicates(frame).collect()
    assert len(found) == frame.count()
    by = {}
    for r in found:
        if shingles(r["text"]):
            by.setdefault(frozenset(shingles(r["text"]).items()), []).append(r)
        else:
            assert r["kept"] and r["class_size"] == 1
    for members in by.values():
        assert sum(r["kept"] for r in members) == 1 and {r["class_size"] for r in members} == {len(members)}
    assert {r["text"] for r in found if r["doc_id"] == 0} == {None}
    assert bag.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_signatures_are_unbiased(seed):
    rng = np.random.default_rng(seed)
    estimates, truth = [], []
    for trial in range(20):
        n = int(rng.integers(2, 120))
        keys = bag.mixed(rng.integers(0, 2**60, n).astype(np.uint64))
        a, b = rng.integers(0, 40, n), rng.integers(0, 40, n)
        of = np.repeat([0, 1], [np.count_nonzero(a), np.count_nonzero(b)])
        sig = bag.signatures(
            2, of, np.concatenate([keys[a > 0], keys[b > 0]]), np.concatenate([a[a > 0], b[b > 0]]), 2048
        )
        estimates.append((sig[0] == sig[1]).mean())
        truth.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        assert abs(estimates[-1] - truth[-1]) < 5 * (0.25 / 2048) ** 0.5
    assert abs(np.mean(estimates) - np.mean(truth)) < 4 * (0.25 / 2048 / 20) ** 0.5


def test_signature_does_not_depend_on_neighbours():
    texts = ["a b c d e f g h", "x " * 700, "", "only two", "a b c d e f g h"]
    of, h, w = bag.weighted_shingles(texts)
    together = bag.signatures(5, of, h, w, 64)
    for i, t in enumerate(texts):
        o, hh, ww = bag.weighted_shingles([t])
        assert np.array_equal(bag.signatures(1, o, hh, ww, 64)[0], together[i])
    assert np.isinf(together[2]).all()


def test_components(spark):
    pairs = [(b"a", b"b"), (b"b", b"c"), (b"x", b"y"), (b"d", b"c"), (b"e", b"d"), (b"a", b"a"), (b"b", b"a")]
    pairs += [(b"p%02d" % i, b"p%02d" % (i + 1)) for i in range(40)]
    found = components(spark.createDataFrame([(bytearray(u), bytearray(v)) for u, v in pairs], "u binary, v binary"))
    got = {bytes(r["node"]): bytes(r["comp"]) for r in found.collect()}
    want = {x: b"a" for x in (b"a", b"b", b"c", b"d", b"e")} | {b"x": b"x", b"y": b"x"}
    assert got == want | {b"p%02d" % i: b"p00" for i in range(41)}


def test_texts_without_a_partner_are_not_shuffled_at_the_end(spark, monkeypatch):
    same = "one two three four five six seven eight nine ten eleven twelve"
    frame = documents(spark, [same, *[f"text {i} of its own words {i * 7} and {i * 11}" for i in range(40)], same, None])
    result = bag.near_duplicates(frame)
    assert read_without_shuffle(result, "text")
    rows = {r["doc_id"]: (r["class_id"], r["class_size"], r["kept"]) for r in result.collect()}
    assert rows == {i: (i, 1, True) for i in range(43)} | {0: (0, 2, True), 41: (0, 2, False)}
    # Filters that let nearly all through change nothing.
    monkeypatch.setattr(bag, "broadcast_blocks", lambda keys: 1)
    monkeypatch.setattr(url_filter, "_masks", lambda key: [F.lit(1).cast("long")] * url_filter.WORDS)
    check(frame)
