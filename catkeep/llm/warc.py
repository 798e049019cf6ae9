"""WARC archives with revisit records for payloads seen before.

Headers are grouped by payload digest; the record with the smallest id holds the payload, later ones
refer to it. Archives are written by Spark's text sink: a record ends with the two line breaks that are
the sink's separator, so files of any file system Spark knows are plain WARC. Reading goes by
Content-Length, so payloads may hold anything. Revisit records are resolved by a join with the originals.
Files are bounded in bytes: payloads of one class of sizes share files, the fewer the larger they are. They
are read as a stream of records, so a task holds a compressed file and a bounded batch of payloads.

Defined cases: null html is an empty payload, always a response; a null url leaves the target out; rows
with a null page_id are written as responses of their own and never referred to; of rows with equal id and
payload one is the response and the others revisit it; line breaks in urls are percent-encoded; an empty
table gives an archive without records. Other columns are not carried.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catkeep.llm.common import written

#: Payloads below are never replaced by a reference.
MIN_PAYLOAD = 100
#: Bytes of payload in one archive file, but for a single larger payload, and records in it.
FILE_BYTES, RECORDS_PER_FILE = 64 << 20, 2000
#: Payload bytes and records that a reader puts into one batch.
BATCH_BYTES, BATCH_RECORDS = 8 << 20, 500
BREAK = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
WRITTEN_AT = "2024-01-01T00:00:00Z"
RECORD = (
    "record_id string, record_type string, page_id long, url string, payload_digest string,"
    " payload_bytes long, found_digest string, refers_to_record string, payload binary"
)


def _payload() -> Column:
    return F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")


def headers(pages: DataFrame) -> DataFrame:
    """page_id, url, digest and size of every payload."""
    payload = _payload()
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.sha2(payload, 256).alias("payload_digest"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        payload.alias("payload"),
    )


def originals(rows: DataFrame, min_payload: int) -> DataFrame:
    """Per digest that several records share, the one that keeps the payload.

    Equal ids are told apart by ``_row``; one row per digest and task is shuffled.
    """
    shared = rows.where((F.col("payload_bytes") >= min_payload) & F.col("page_id").isNotNull())
    return (
        shared.groupBy("payload_digest")
        .agg(F.min(F.struct("page_id", "_row")).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("payload_digest", F.col("first.page_id").alias("first_page"), F.col("first._row").alias("first_row"))
    )


def record_id(page: Column, row: Column) -> Column:
    """A URN that depends on the row alone, so that a repeated task writes the same record."""
    digest = F.md5(F.concat_ws(":", page.cast("string"), row))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def marked(rows: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Rows with record_type, refers_to and the ids of their record and of the one referred to."""
    firsts = originals(rows.drop("payload"), min_payload)
    joined = rows.join(firsts, "payload_digest", "left")
    again = (
        F.col("first_page").isNotNull()
        & F.col("page_id").isNotNull()
        & (F.col("payload_bytes") >= min_payload)
        & ~((F.col("page_id") == F.col("first_page")) & (F.col("_row") == F.col("first_row")))
    )
    return joined.withColumn("_again", F.coalesce(again, F.lit(False))).withColumns(
        {
            "record_type": F.when(F.col("_again"), "revisit").otherwise("response"),
            "record_id": record_id(F.col("page_id"), F.col("_row")),
            "refers_to": F.when(F.col("_again"), F.col("first_page")),
            "refers_to_record": F.when(F.col("_again"), record_id(F.col("first_page"), F.col("first_row"))),
        }
    ).drop("_again", "first_page", "first_row")


def _line(name: str, value: Column) -> Column:
    """A header line; nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(BREAK)), F.lit(""))


def record(rows: DataFrame) -> Column:
    """The whole record but for the two line breaks that end it."""
    revisit = F.col("record_type") == "revisit"
    block = F.concat(F.lit(HTTP), F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string")))
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit(f"WARC/1.1{BREAK}"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.lit(WRITTEN_AT)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.col("refers_to_record")),
        _line("X-Page-Id", F.col("page_id")),
        F.lit(f"Content-Type: application/http; msgtype=response{BREAK}"),
        _line("Content-Length", F.octet_length(block)),
        F.lit(BREAK),
        block,
    )


def size_limits(file_bytes: int = FILE_BYTES, records: int = RECORDS_PER_FILE) -> list[int]:
    """Largest payload of each class of sizes but the last, whose payloads have a file each."""
    limits = [max(1, file_bytes // records)]
    while limits[-1] * 16 < file_bytes:
        limits.append(limits[-1] * 16)
    return [*limits, file_bytes]


def _size_class(limits: list[int]) -> Column:
    """Number of the first limit that a payload does not exceed."""
    steps = [F.when(F.col("payload_bytes") > limit, 1).otherwise(0) for limit in limits]
    return sum(steps[1:], steps[0])


def write_archives(rows: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Add marked rows to compressed archive files of at most so many records."""
    (
        rows.select(record(rows).alias("value"))
        .write.mode("append")
        .option("lineSep", BREAK * 2)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", "gzip")
        .text(path)
    )


def _records(archive: BinaryIO) -> Iterator[tuple]:
    """The records of a plain archive, one at a time."""
    while first := archive.readline():
        version, lines = first.rstrip(b"\r\n").decode("utf-8", "surrogateescape"), []
        if not version.startswith("WARC/"):
            raise ValueError(f"no record where {version[:40]!r} stands")
        while (line := archive.readline()) != b"\r\n":
            if not line:
                raise ValueError("an archive ends inside a header")
            lines.append(line[:-2].decode("utf-8", "surrogateescape"))
        fields = dict(line.split(": ", 1) for line in lines)
        length = int(fields["Content-Length"])
        block = archive.read(length)
        if len(block) < length or archive.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {fields['WARC-Record-ID']} is cut off")
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        revisit = fields["WARC-Type"] == "revisit"
        page = fields.get("X-Page-Id")
        yield (
            fields["WARC-Record-ID"],
            fields["WARC-Type"],
            None if page is None else int(page),
            fields.get("WARC-Target-URI"),
            fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            None if revisit else len(payload),
            None if revisit else hashlib.sha256(payload).hexdigest(),
            fields.get("WARC-Refers-To"),
            None if revisit else payload,
        )


def _plain(content: bytes) -> BinaryIO:
    """An archive's plain bytes as a stream; the archive may be compressed."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 16) if content[:2] == b"\x1f\x8b" else raw


def _batches(records: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Records in lists of bounded number and, but for single large ones, bounded bytes."""
    held, size = [], 0
    for r in records:
        held.append(r)
        size += r[5] or 0
        if len(held) >= BATCH_RECORDS or size >= BATCH_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; digest and size of responses are taken from the bytes read."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(RECORD))

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for held in _batches(_records(_plain(content.as_py()))):
                    columns = zip(*held, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, RECORD)


def resolve(records: DataFrame) -> DataFrame:
    """Revisit records joined to the response they refer to, which must hold the digest they name.

    A response whose bytes do not have the digest in its header, or a revisit without its original, ends
    the job.
    """
    shared = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    responses = records.where("record_type = 'response'")
    checked = responses.withColumn(
        "payload_digest",
        F.when(F.col("found_digest") == F.col("payload_digest"), F.col("payload_digest")).otherwise(
            F.raise_error(F.concat(F.lit("wrong digest in "), F.col("record_id")))
        ),
    )
    firsts = responses.select(
        F.col("record_id").alias("refers_to_record"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("found_bytes"),
        F.col("found_digest").alias("original_digest"),
    )
    found = (
        records.where("record_type = 'revisit'")
        .select("page_id", "payload_digest", "record_type", "refers_to_record")
        .join(firsts, "refers_to_record", "left")
        .withColumn(
            "payload_bytes",
            F.when(F.col("original_digest") == F.col("payload_digest"), F.col("found_bytes")).otherwise(
                F.raise_error(F.concat(F.lit("no original for "), F.col("refers_to_record"))).cast("long")
            ),
        )
    )
    return checked.select(*shared, F.lit(None).cast("long").alias("refers_to")).unionByName(
        found.select(*shared, "refers_to")
    )


def archive(
    pages: DataFrame,
    path: str,
    min_payload: int = MIN_PAYLOAD,
    file_bytes: int = FILE_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write ``pages`` (page_id, url, html) as archives without repeated payloads.

    Each class of payload sizes that occurs is written on its own, with as many records to a file as
    keep it within ``file_bytes``; mostly there is one class.
    """
    rows = headers(pages)
    keys = F.concat_ws(":", F.coalesce("url", F.lit("")), F.col("payload_digest"))
    # Rows that agree in id, url and payload still need ids of their own: they are numbered.
    rows = rows.withColumn("_row", keys)
    limits = size_limits(file_bytes, records_per_file)
    counted = rows.groupBy("page_id", "_row").agg(
        F.count(F.lit(1)).alias("n"), F.first(_size_class(limits)).alias("size")
    )
    [(most, classes)] = counted.agg(F.max("n"), F.collect_set("size")).collect()
    if (most or 0) > 1:
        rows = written(
            rows.withColumn("_row", F.concat_ws("#", "_row", F.monotonically_increasing_id())), "warc-rows"
        )
    found = marked(rows, min_payload)
    # An empty table still gives an archive, of one class without records.
    for number in sorted(classes) or [0]:
        here = found.where(_size_class(limits) == number) if len(classes) > 1 else found
        within = max(1, file_bytes // limits[number]) if number < len(limits) else 1
        write_archives(here, path, min(records_per_file, within))
