"""Byte-level BPE over a global shuffle of distinct words.

Encoding goes in four steps. (1) Each block of documents is split into pre-tokens; the block keeps the
number of the word at every position, and its distinct words are dealt into hash buckets. (2) Buckets
meet in one task each, wherever a word comes from, and each distinct word is encoded once. (3) The ids
go back to the blocks. (4) Each block puts the ids of its words at their positions. A block sends every
word once however often it occurs, so a frequent word is no hot key, and position lists move once.

Decoding looks every id up in the table of token bytes.

Defined cases: a null or empty text has no ids and decodes to no bytes; null and repeated document ids
come back as they are; texts are never cut, one longer than a block is a block of its own; an id that
the table lacks, or null ids, is an error in decoding. Other input columns are not carried.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import arrow_rows, scratch, text_or_empty

#: Characters of text in a block.
BLOCK_CHARS = 7_000_000
#: Words a task remembers with their ids; the memory is started anew beyond that.
REMEMBERED = 400_000
#: Ids in one batch that goes back to Spark.
BATCH_IDS = 1_000_000

BLOCK_TYPE = (
    "block long, doc_ids array<long>, counts array<int>, codes binary, buckets binary,"
    " parts array<struct<bucket: int, first: int, sizes: binary, words: binary>>"
)
PIECE_TYPE = "block long, first int, counts binary, ids binary"

#: What a pattern tells characters apart by, and a character of each such class that libraries agree on.
CLASSES = {r"\p{L}": "\u3042", r"\p{N}": "\u0660", r"\s": "\u3000"}
OTHER = "\u2020"


def as_the_library(kind: str) -> set[str]:
    """Characters of a class in the tables of the rank files' own library, which splits by its own pattern."""
    import tiktoken

    one_byte = {bytes([i]): i for i in range(256)}
    finder = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks=one_byte, special_tokens={})
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    return set(bytes(finder.encode_ordinary(every)).decode("utf-8"))


@cache
def stand_ins() -> dict[str, str]:
    """Characters that the two libraries class differently, each with one that both class as the rank
    files' library does."""
    import regex

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    made: dict[str, str] = {}
    for kind, like in CLASSES.items():
        here, there = set(regex.findall(kind, every)), as_the_library(kind)
        made.update(dict.fromkeys(there - here, like))
        for char in here - there:
            made.setdefault(char, OTHER)
    return made


class Splitter:
    """Pieces of a text by a pattern, as the rank files' library cuts it."""

    def __init__(self, pattern: str) -> None:
        import regex

        self.findall = regex.compile(pattern).findall
        self.table = str.maketrans(stand_ins())
        self.odd = frozenset(stand_ins())
        # Most texts lie below all of these characters, which one look at the text tells.
        self.high = re.compile(f"[^\\x00-\\U{ord(min(self.odd, default=chr(0x10FFFF))) - 1:08x}]").search

    def __call__(self, text: str) -> list[str]:
        if not self.high(text) or self.odd.isdisjoint(text):
            return self.findall(text)
        pieces, at = [], 0
        for piece in self.findall(text.translate(self.table)):
            pieces.append(text[at : at + len(piece)])
            at += len(piece)
        return pieces


@cache
def splitter(pattern: str) -> Splitter:
    """The pattern must cover every character, as the library's patterns do."""
    return Splitter(pattern)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@cache
def token_table(path: str) -> pa.Array:
    """Bytes of each id, by position."""
    ranks = read_ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.large_binary())


class _Words(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def packed(numbers: np.ndarray) -> bytes:
    """32-bit numbers, compressed by byte planes: the high bytes are mostly alike."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _block_row(block: int, documents: list[tuple], pattern: str, buckets: int) -> dict:
    """Words are numbered by falling frequency, which packs best; a bucket holds its words in that order."""
    words, find = _Words(), splitter(pattern)
    number, codes, counts = words.__getitem__, [], []
    for _, text in documents:
        codes.append(np.fromiter(map(number, found := find(text)), np.uint32, len(found)))
        counts.append(len(found))
    flat = np.concatenate(codes) if codes else np.empty(0, np.uint32)
    by_rank = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[by_rank] = np.arange(len(words), dtype=np.uint32)
    names = [w.encode("utf-8", "surrogatepass") for w in words]
    of = np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))[by_rank]
    order = np.argsort(of, kind="stable")
    edges = np.append(np.flatnonzero(np.diff(of[order], prepend=-1)), len(order))
    dealt = by_rank[order]
    parts = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        held = [names[i] for i in dealt[a:b]]
        sizes = np.fromiter(map(len, held), np.uint32, len(held))
        parts.append(
            {
                "bucket": int(of[order[a]]), "first": int(a),
                "sizes": packed(sizes), "words": zstandard.compress(b"".join(held)),
            }
        )
    return {
        "block": block, "doc_ids": [d for d, _ in documents], "counts": counts,
        "codes": packed(rank[flat]), "buckets": packed(of), "parts": parts,
    }


def words_in(sizes: bytes, words: bytes) -> Iterator[bytes]:
    content, at = zstandard.decompress(words), 0
    for size in unpacked(sizes).tolist():
        yield content[at : at + size]
        at += size


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def blocks_of(documents: DataFrame, pattern: str, buckets: int, block_chars: int) -> DataFrame:
    """One row per block: documents, their pre-tokens as numbers of words, words dealt into buckets."""
    schema = _arrow_schema(BLOCK_TYPE)

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        block = TaskContext.get().partitionId() << 32
        for row in arrow_rows(batches, "doc_id", "text"):
            if held and size + len(row[1]) > block_chars:
                yield _batch([_block_row(block, held, pattern, buckets)], schema)
                held, size, block = [], 0, block + 1
            held.append(row)
            size += len(row[1])
        if held:
            yield _batch([_block_row(block, held, pattern, buckets)], schema)

    return documents.mapInArrow(split, BLOCK_TYPE)


def encode_words(parts: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Rows of words in the task of their bucket become rows of ids; each word is encoded once."""
    schema = _arrow_schema(PIECE_TYPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one_word = encoder(ranks_path, pattern)._core_bpe.encode_single_piece
        known: dict[bytes, bytes] = {}
        for block, first, sizes, words in arrow_rows(batches, "block", "first", "sizes", "words"):
            found = []
            for word in words_in(sizes, words):
                ids = known.get(word)
                if ids is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids = np.asarray(one_word(word), "<u4").tobytes()
                found.append(ids)
            counts = np.fromiter(map(len, found), np.uint32, len(found)) // 4
            flat = np.frombuffer(b"".join(found), "<u4")
            yield _batch(
                [
                    {
                        "block": block,
                        "first": first,
                        "counts": packed(counts),
                        "ids": packed(flat),
                    }
                ],
                schema,
            )

    return parts.mapInArrow(run, PIECE_TYPE)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions starts[i], starts[i] + 1, ... for counts[i] places, one after another."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - counts), counts)


def _assemble(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("doc_ids", "counts", "codes", "buckets", "pieces")
    for doc_ids, counts, codes, buckets, pieces in arrow_rows(batches, *names):
        pieces = sorted(pieces or [], key=lambda p: p["first"])
        word_ids = np.concatenate([unpacked(p["ids"]) for p in pieces] or [np.empty(0, np.uint32)])
        dealt = np.concatenate([unpacked(p["counts"]) for p in pieces] or [np.empty(0, np.uint32)])
        # Pieces come bucket by bucket; words are numbered by frequency.
        order = np.argsort(unpacked(buckets), kind="stable")
        word_counts, word_starts = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        word_counts[order] = dealt
        word_starts[order] = np.cumsum(dealt, dtype=np.int64) - dealt
        codes = unpacked(codes)
        edges = np.concatenate([[0], np.cumsum(np.asarray(counts, np.int64))])
        sizes = word_counts[codes]
        ends = np.concatenate([[0], np.cumsum(sizes)])[edges]
        at = 0
        while at < len(doc_ids):
            until = max(at + 1, int(np.searchsorted(ends, ends[at] + BATCH_IDS, "right")) - 1)
            part = codes[edges[at] : edges[until]]
            flat = word_ids[_spread(word_starts[part], word_counts[part])].astype(np.int32)
            offsets = (ends[at : until + 1] - ends[at]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids[at:until], pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))],
                ["doc_id", "ids"],
            )
            at = until


def stored_by_block(blocks: DataFrame, buckets: int) -> DataFrame:
    """Blocks as a table in the shared folder, bucketed by block.

    Ids that come back are dealt like the table, so the positions in it, the bulk of the data, are read
    where they lie and not shuffled. The table is known to the session's catalog by a name of its own.
    """
    spark = blocks.sparkSession
    path = scratch(spark, "bpe-blocks")
    name = f"bpe_blocks_{path[-32:]}"
    (
        blocks.write.format("parquet").option("compression", "zstd").option("path", path)
        .bucketBy(buckets, "block").sortBy("block").saveAsTable(name)
    )
    return spark.table(name)


def encode(
    documents: DataFrame, ranks_path: str, pattern: str, block_chars: int = BLOCK_CHARS, buckets: int | None = None
) -> DataFrame:
    """doc_id and ids (array<int>) of every row of ``documents`` (doc_id, text).

    ``buckets`` is the number of groups of words, by default the session's shuffle partitions.
    """
    spark = documents.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    blocks = stored_by_block(blocks_of(rows, pattern, buckets, block_chars), buckets)
    parts = blocks.select("block", F.explode("parts").alias("part")).select(
        "block", "part.bucket", "part.first", "part.sizes", "part.words"
    )
    pieces = encode_words(parts.repartition(buckets, "bucket").drop("bucket"), ranks_path, pattern)
    gathered = pieces.groupBy("block").agg(
        F.collect_list(F.struct("first", "counts", "ids")).alias("pieces")
    )
    return (
        blocks.select("block", "doc_ids", "counts", "codes", "buckets")
        .join(gathered, "block", "left")
        .select("doc_ids", "counts", "codes", "buckets", "pieces")
        .mapInArrow(_assemble, "doc_id long, ids array<int>")
    )


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes that its ids stand for, as a binary column."""
    out = encoded.drop(into).withColumn(into, F.lit(None).cast("binary"))
    at = encoded.drop(into).columns.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(ranks_path)
        for batch in batches:
            lists = batch.column(at)
            found = pc.take(table, lists.flatten())
            if lists.null_count or found.null_count:
                raise ValueError("ids are null or not in the table of tokens")
            offsets = pc.subtract(lists.offsets, lists.offsets[0]).cast(pa.int64())
            joined = pc.binary_join(pa.LargeListArray.from_arrays(offsets, found), pa.scalar(b"", pa.large_binary()))
            columns = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != into]
            names = [n for n in batch.schema.names if n != into]
            yield pa.RecordBatch.from_arrays([*columns, joined.cast(pa.binary())], [*names, into])

    return encoded.drop(into).mapInArrow(run, out.schema)
