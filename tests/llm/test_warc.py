import hashlib

from catkeep.llm import warc
from catkeep.llm.common import written
from catkeep.session import scratch_path

PAGES = "page_id long, url string, html string"
BIG = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "x" * 100
ROWS = [
    (5, "http://a/", BIG), (2, "http://b/", BIG), (9, None, BIG), (2, "http://b/", BIG), (1, "http://c/\r\nX: y", "short"),
    (4, "u", "short"), (7, "u", None), (8, "u", ""), (None, "u", BIG), (None, None, None), (10, "u", "é" * 50),
    (11, "u", "é" * 50), (12, "u", "y" * 99), (13, "u", "y" * 99), (14, "v", "z" * 200_000), (15, "w", "\r\n\r\n"),
]


def roundtrip(spark, pages):
    path = scratch_path(spark, "warc")
    warc.archive(pages, path)
    return path, written(warc.read_archives(spark, path), "read")


def brute(rows):
    firsts = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    out, seen = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        first = firsts.get(html) if page is not None else None
        again = first is not None and (page != first or html in seen)
        seen.add(html if page is not None else object())
        digest = hashlib.sha256(data).hexdigest()
        out.append((page, len(data), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_roundtrip(spark):
    frame = spark.createDataFrame(ROWS, PAGES).selectExpr("*", "'x' AS record_type", "1 AS payload").repartition(3)
    path, records = roundtrip(spark, frame)
    assert sorted((tuple(r) for r in warc.resolve(records).collect()), key=str) == brute(ROWS)
    assert records.count() == records.select("record_id").distinct().count() == len(ROWS)
    payloads = {r["page_id"]: bytes(r["payload"]) for r in records.where("record_type = 'response'").collect()}
    assert payloads[14] == b"z" * 200_000 and payloads[15] == b"\r\n\r\n" and payloads[2] == BIG.encode()
    urls = {r["page_id"]: r["url"] for r in records.collect()}
    assert urls[1] == "http://c/%0D%0AX: y" and urls[9] is None


def test_archives_are_plain_records(spark):
    path, _ = roundtrip(spark, spark.createDataFrame(ROWS[:2], PAGES).coalesce(1))
    [content] = [r[0] for r in spark.read.text(path, wholetext=True).collect()]
    assert content.startswith("WARC/1.1\r\n") and content.endswith("\r\n\r\n")
    assert content.count("WARC-Type: revisit\r\n") == 1 and content.count(f"WARC-Profile: {warc.PROFILE}") == 1


def test_no_rows(spark):
    _, records = roundtrip(spark, spark.createDataFrame([], PAGES))
    assert warc.resolve(records).count() == 0


def test_files_are_bounded_in_bytes(spark):
    """Small, larger and very large payloads have files of their own, all within the bound but single ones."""
    rows = [(i, f"u{i}", f"{i} " + "x" * size) for i, size in enumerate([10] * 40 + [900] * 12 + [5000] * 3 + [60_000] * 2)]
    path = scratch_path(spark, "warc")
    warc.archive(spark.createDataFrame(rows, PAGES).coalesce(1), path, file_bytes=8000, records_per_file=20)
    assert warc.size_limits(8000, 20) == [400, 6400, 8000]
    sizes = [
        sum(len(block) for block in content.split("Content-Length")[1:])
        for (content,) in spark.read.text(path, wholetext=True).collect()
    ]
    assert len(sizes) == 2 + 12 + 3 + 2 and max(sizes) < 62_000
    assert sorted((tuple(r) for r in warc.resolve(warc.read_archives(spark, path)).collect()), key=str) == brute(rows)


def test_cut_archives_are_refused():
    import io

    import pytest

    whole = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: a\r\nContent-Length: 9\r\n\r\n"
    for content in (whole + b"short", whole[:20], b"no record\r\n"):
        with pytest.raises(ValueError):
            list(warc._records(io.BytesIO(content)))
