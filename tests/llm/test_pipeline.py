import re
from collections import defaultdict

import corpus_pipeline
from catkeep.llm import bagminhash, exact_dedup, license_scan, line_dedup, toxicity
from tests.llm.helpers import documents, no_documents, odd_documents, table
from tests.llm.test_bagminhash import classes
from tests.llm.test_packing import whole_ids


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


def test_stages_against_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, sf_dir)
        assert result.columns == names
        kept = {r["doc_id"]: r["text"] for r in result.collect()}
        if name == "toxicity":
            net = toxicity.train(docs, table(spark, sf_dir, "labels"))
            rows = toxicity.score(docs, net).collect()
            assert set(kept) == {r["doc_id"] for r in rows if r["score"] < 0.5}
            assert len(kept) > 0.7 * len(before)
        elif name == "exact_dedup":
            best = {}
            for i, t in sorted(before.items()):
                if normal(t) not in best or len(t or "") > len(before[best[normal(t)]] or ""):
                    best[normal(t)] = i
            assert set(kept) == set(best.values())
        else:
            ids = sorted(before)
            assert set(kept) == {min(ids[i] for i in c) for c in classes([before[i] for i in ids])}
        assert all(before[i] == t for i, t in kept.items())
        docs, before = spark.createDataFrame(result.collect(), result.schema), kept
    pieces = defaultdict(int)
    for p in corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect():
        pieces[p["doc_id"]] += p["length"]
    assert pieces == {i: len(whole_ids(t)) for i, t in before.items()}


def test_odd_and_empty_input(spark, sf_dir):
    for frame in (odd_documents(spark), no_documents(spark)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf_dir)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            assert docs.columns == frame.columns
        found = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert {r["doc_id"] for r in found.collect()} == {r["doc_id"] for r in docs.collect()}


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 100


def test_columns_named_like_helpers(spark, sf_dir):
    own = ("_row", "_text", "_x", "_node", "_site", "_metadata", "_input", "_digest", "_words", "input_5")
    frame = documents(spark, ["a b", "a  b", None, "licensed under the MIT license"], **{c: f"v{c}" for c in own})
    first = corpus_pipeline.STAGES[0][1](spark, frame, sf_dir)
    assert first.columns == frame.columns
    results = [
        exact_dedup.dedup(frame), bagminhash.near_duplicates(frame), license_scan.scan(frame),
        line_dedup.remove_spread_lines(frame), corpus_pipeline.drop_copies(spark, frame, sf_dir),
        corpus_pipeline.drop_near_copies(spark, frame, sf_dir),
    ]
    for result, n in zip(results, (4, 4, 4, 4, 3, None), strict=True):
        rows = result.collect()
        assert len(rows) == n if n else rows
        assert {c: f"v{c}" for c in own}.items() <= rows[0].asDict().items()
        assert all(r[c] == f"v{c}" for r in rows for c in own)
