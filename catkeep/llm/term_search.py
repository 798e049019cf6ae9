"""Ranked lexical search by pipelined term partitioning.

Documents are indexed once in shards: for every term that an item asks for, the shard's documents that
hold it and how often. Terms are owned by stages, the heaviest (rarest) by the first. A bundle is a
block of items together with one shard: it carries the shard's document lengths and, per item, a sparse
accumulator of document scores. It goes from stage to stage by a cogroup with the postings that the
stage owns, and every stage adds its integer contributions. The last stage selects each item's best
documents of the shard; what is left of all shards is ranked once more. As common terms come last, the
accumulators that are shuffled are those of rare terms, and the nearly full ones of the last stage are not.

A group has at most ``shard_docs`` documents and about ``block_items`` items, whatever the input. Which
terms an item asks for is told to the indexing tasks by a bit map of fixed size; terms that only share
a bit with one are removed by the join with the items' terms.

Defined cases: a null or empty text has no terms; items without terms, or without a document that
scores, have no rows; rows with the same item id are one item; null ids are ids like others and sort
first; repeated documents are ranked row by row; texts are never cut; no rows give no rows. Other columns
are not carried.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catkeep.llm.common import arrow_rows, ascii_lower, text_or_empty, written

BEST = 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same in UTF-8, where every byte of a character beyond ASCII is above 0x7F.
TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
SHARD_DOCS, SHARD_POSTINGS, BLOCK_ITEMS = 16_384, 4_000_000, 128
#: Least weight of the terms that each stage but the last owns: in one document of 400, one of 25.
STAGE_WEIGHTS = (6000, 3200)
#: Bits of the map of wanted terms.
MAP_BITS = 1 << 21

INDEX_TYPE = (
    "shard long, term string, slots binary, tfs binary, df long, doc_ids array<long>, lengths binary,"
    " docs long, terms long"
)
BUNDLE_TYPE = (
    "shard long, block int, doc_ids array<long>, lengths binary, items array<long>, counts array<long>,"
    " slots binary, scores binary"
)
FOUND_TYPE = "item_id long, doc_id long, score long"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers, compressed by byte planes."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T
    return zstandard.compress(planes.tobytes())


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in ddl.split(","))])


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and each of its terms once."""
    found = F.regexp_extract_all(ascii_lower(text_or_empty()), F.lit(f"({TERM})"), F.lit(1))
    return items.select(F.col("item_id").cast("long").alias("item_id"), F.explode(found).alias("term")).distinct()


def wanted_map(terms: DataFrame) -> np.ndarray:
    """A bit map over hashes of terms: at most MAP_BITS / 64 numbers, whatever the terms."""
    bit = F.expr(f"crc32(cast(term AS binary)) % {MAP_BITS}")
    words = (
        terms.select((bit / 64).cast("int").alias("word"), (bit % 64).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    )
    held = np.zeros(MAP_BITS // 64, "<i8")
    for word, bits in words.collect():
        held[word] = bits
    return np.unpackbits(held.view(np.uint8), bitorder="little").astype(bool)


class _Shard:
    """Documents of one shard and where the wanted terms stand in them."""

    def __init__(self) -> None:
        self.doc_ids: list[int | None] = []
        self.lengths = array("I")
        self.postings: dict[bytes, tuple[array, array]] = {}
        self.size = 0

    def add(self, doc_id: int | None, text: bytes, wanted: np.ndarray) -> None:
        words = TERM_BYTES.findall(text.lower())
        slot = len(self.doc_ids)
        self.doc_ids.append(doc_id)
        self.lengths.append(len(words))
        counts = Counter(words)
        hashes = np.fromiter(map(zlib.crc32, counts), np.int64, len(counts))
        for term, tf in compress(counts.items(), wanted[hashes % len(wanted)].tolist()):
            held = self.postings.get(term)
            if held is None:
                held = self.postings[term] = (array("H"), array("I"))
            held[0].append(slot)
            held[1].append(tf)
            self.size += 1

    def rows(self, shard: int) -> Iterator[dict]:
        yield {
            "shard": shard, "doc_ids": self.doc_ids, "lengths": packed(np.asarray(self.lengths)),
            "docs": sum(map(bool, self.lengths)), "terms": sum(self.lengths),
        }
        for term, (slots, tfs) in self.postings.items():
            yield {
                "shard": shard, "term": term.decode("utf-8"), "df": len(slots),
                "slots": packed(np.asarray(slots)), "tfs": packed(np.asarray(tfs)),
            }


def index(documents: DataFrame, wanted: np.ndarray, shard_docs: int) -> DataFrame:
    """Per shard one row for its documents (no term) and one for each wanted term in them."""
    schema = arrow_schema(INDEX_TYPE)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = TaskContext.get().partitionId() << 32, _Shard()
        for doc_id, text in arrow_rows(batches, "doc_id", "text"):
            if len(held.doc_ids) == shard_docs or held.size >= SHARD_POSTINGS:
                yield pa.RecordBatch.from_pylist(list(held.rows(shard)), schema)
                shard, held = shard + 1, _Shard()
            held.add(doc_id, text, wanted)
        if held.doc_ids:
            yield pa.RecordBatch.from_pylist(list(held.rows(shard)), schema)

    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text")
    )
    return rows.mapInArrow(run, INDEX_TYPE)


def owned_terms(terms: DataFrame, indexed: DataFrame, docs: int, blocks: int, stages: tuple[int, ...]) -> DataFrame:
    """Per term, owning stage and block of items: the items that ask for it, with the term's weight."""
    frequency = indexed.where("term IS NOT NULL").groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * docs + 2.0) / (2 * F.col("df") + 1)
    owner = sum((F.when(F.col("w") < least, 1).otherwise(0) for least in stages), F.lit(0))
    return (
        terms.join(frequency, "term")
        .withColumn("w", F.floor(1000 * F.ln(ratio)).cast("long"))
        .where("w > 0")
        .groupBy(
            "term",
            owner.cast("int").alias("stage"),
            F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int").alias("block"),
        )
        .agg(F.collect_list("item_id").alias("known"), F.count(F.lit(1)).alias("asked"), F.first("w").alias("w"))
        .withColumn("no_id", F.col("asked") > F.size("known"))
        .drop("asked")
    )


class _Bundle:
    """The accumulators of one block of items over one shard."""

    def __init__(self, row: dict) -> None:
        self.row = row
        self.lengths = unpacked(row["lengths"], "<u4").astype(np.int64)
        self.sums: dict[int | None, np.ndarray] = {}
        if row["items"]:
            edges = np.cumsum([0, *row["counts"]]).tolist()
            slots, scores = unpacked(row["slots"], "<u2"), unpacked(row["scores"], "<i8")
            for item, a, b in zip(row["items"], edges[:-1], edges[1:], strict=True):
                self._of(item)[slots[a:b]] = scores[a:b]

    def _of(self, item: int | None) -> np.ndarray:
        held = self.sums.get(item)
        if held is None:
            held = self.sums[item] = np.zeros(len(self.lengths), np.int64)
        return held

    def add(self, postings: pa.Table, docs: int, terms: int) -> None:
        norms = 100 - 50 + (50 * self.lengths * docs) // terms
        names = ("slots", "tfs", "known", "no_id", "w")
        for slots, tfs, known, no_id, weight in zip(*(postings[n].to_pylist() for n in names), strict=True):
            slots, tfs = unpacked(slots, "<u2"), unpacked(tfs, "<u4").astype(np.int64)
            parts = weight * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * norms[slots]))
            for item in [*known, None] if no_id else known:
                self._of(item)[slots] += parts

    def table(self) -> pa.Table:
        slots = {item: np.flatnonzero(held) for item, held in self.sums.items()}
        row = self.row | {
            "items": list(slots),
            "counts": [len(s) for s in slots.values()],
            "slots": packed(np.concatenate([np.empty(0, np.int64), *slots.values()]).astype("<u2")),
            "scores": packed(np.concatenate([np.empty(0, np.int64), *(self.sums[i][s] for i, s in slots.items())])),
        }
        return pa.Table.from_pylist([row], arrow_schema(BUNDLE_TYPE))

    def best(self, k: int) -> pa.Table:
        """Each item's k best documents, equal scores by document id."""
        doc_ids = self.row["doc_ids"]
        order = np.array([-(1 << 63) if d is None else d for d in doc_ids], np.int64)
        rows: list[tuple] = []
        for item, held in self.sums.items():
            slots = np.flatnonzero(held > 0)
            if len(slots) > k:
                least = np.partition(held[slots], len(slots) - k)[len(slots) - k]
                slots = slots[held[slots] >= least]
            slots = slots[np.lexsort((order[slots], -held[slots]))][:k]
            rows.extend((item, doc_ids[s], int(held[s])) for s in slots.tolist())
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        schema = arrow_schema(FOUND_TYPE)
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def search(
    documents: DataFrame,
    items: DataFrame,
    k: int = BEST,
    stages: tuple[int, ...] = STAGE_WEIGHTS,
    shard_docs: int = SHARD_DOCS,
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best ``documents`` (doc_id, text).

    ``items`` has item_id and text. ``shard_docs`` is 65,536 at most.
    """
    terms = written(item_terms(items), "search-terms")
    indexed = written(index(documents, wanted_map(terms), shard_docs), "search-index")
    docs, total = indexed.agg(F.sum("docs"), F.sum("terms")).first()
    docs, total = docs or 0, max(total or 0, 1)
    blocks = max(-(-terms.select("item_id").distinct().count() // block_items), 1)
    owned = written(owned_terms(terms, indexed, docs, blocks, stages), "search-owned")
    # A name of its own, so that both sides of a cogroup are told apart.
    postings = indexed.where("term IS NOT NULL").select(F.col("shard").alias("shard"), "term", "slots", "tfs")

    def pass_on(bundle: pa.Table, own: pa.Table) -> pa.Table:
        if not own.num_rows:
            return bundle
        held = _Bundle(bundle.to_pylist()[0])
        held.add(own, docs, total)
        return held.table()

    def select(bundle: pa.Table, own: pa.Table) -> pa.Table:
        held = _Bundle(bundle.to_pylist()[0])
        held.add(own, docs, total)
        return held.best(k)

    bundles = indexed.where("term IS NULL").select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "doc_ids",
        "lengths",
        F.lit(None).cast("array<long>").alias("items"),
        F.lit(None).cast("array<long>").alias("counts"),
        F.lit(None).cast("binary").alias("slots"),
        F.lit(None).cast("binary").alias("scores"),
    )
    for stage in range(len(stages) + 1):
        own = (
            owned.where(F.col("stage") == stage)
            .join(postings, "term")
            .select("shard", "block", "slots", "tfs", "known", "no_id", "w")
        )
        meeting = bundles.groupBy("shard", "block").cogroup(own.groupBy("shard", "block"))
        last = stage == len(stages)
        bundles = meeting.applyInArrow(select if last else pass_on, FOUND_TYPE if last else BUNDLE_TYPE)
    ranking = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = bundles.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
