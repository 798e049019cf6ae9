import hashlib
import re

from pyspark.sql import functions as F

from catkeep.llm import exact_dedup, url_filter
from catkeep.session import scratch_path
from tests.llm.helpers import documents, no_documents, odd_documents, read_without_shuffle


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", r["text"] or ""), []).append(r)
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda r: (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(r["doc_id"], keep["doc_id"], len(members), sha) for r in members]
    return sorted(out, key=str)


def got(result):
    rows = result.collect()
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows), key=str), rows


def test_odd_rows_and_clashing_columns(spark):
    frame = odd_documents(spark, kept="clash", keeper="also", file="f").repartition(5)
    found, rows = got(exact_dedup.dedup(frame, files_per_trigger=2))
    assert found == brute(frame.collect())
    assert sum(r["kept"] for r in rows) == len({r["text_sha256"] for r in rows})
    assert {"lang", "source", "n_chars", "text", "file"} <= set(rows[0].asDict())


def test_full_content_is_compared_on_hits(spark):
    frame = documents(spark, ["aa", "bb", "a a", "cc", None, "bb "]).repartition(3)
    weak = exact_dedup.dedup(frame, digest=lambda norm: F.unhex(F.lit("00")), files_per_trigger=1)
    assert got(weak)[0] == brute(frame.collect())


def test_state_survives_between_runs(spark):
    landed, states, checkpoint = (scratch_path(spark, f"t-{x}") for x in ("landed", "states", "check"))
    for texts in (["b", "c"], ["b  ", "d", "c"]):
        exact_dedup.land(documents(spark, texts), landed)
        exact_dedup.run_stream(spark, landed, spark.read.parquet(landed).schema, states, checkpoint, 64)
    states = spark.read.option("recursiveFileLookup", "true").parquet(states)
    last = states.where("trigger = 1").select("_keeper.minus_points", "_size")
    assert sorted(map(tuple, last.collect())) == [(-3, 2), (-1, 1), (-1, 2)]


def test_no_rows(spark):
    assert exact_dedup.dedup(no_documents(spark)).count() == 0


def test_content_without_a_partner_is_not_shuffled(spark, monkeypatch):
    frame = documents(spark, [f"text number {i // 2 if i < 6 else i}" for i in range(60)]).repartition(3)
    result = exact_dedup.dedup(frame)
    assert got(result)[0] == brute(frame.collect())
    assert read_without_shuffle(result, "_input")
    # A filter that lets nearly all through changes nothing.
    monkeypatch.setattr(exact_dedup, "broadcast_blocks", lambda keys: 1)
    monkeypatch.setattr(url_filter, "_masks", lambda key: [F.lit(1).cast("long")] * url_filter.WORDS)
    assert got(exact_dedup.dedup(frame))[0] == brute(frame.collect())
