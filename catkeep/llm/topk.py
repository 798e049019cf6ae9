"""Exact top-k by inner product with the threshold algorithm.

Candidates are packed into blocks where they are; a block holds its vectors and, for every dimension, the
list of its rows sorted by that component. Query blocks meet candidate blocks by a join on a group
number; a group is bounded in bytes. The lists are read from the end that a query's component favours, to growing depths,
by the queries of a block together: rows seen for the first time are scored in full, by one product of matrices, and a
query stops when the sum of what the lists show it next cannot reach its kth score. Depths at which no query can stop
are not halted at. Bounds carry over from block to block of a group.

Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows with
a null id; shorter vectors count as filled up with zeros; a query gets fewer than k rows when there are
fewer candidates; rows with equal ids are separate candidates, and a query skips all rows of its own id;
equal scores go to the smaller id; no rows give no rows. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catkeep.llm.common import arrow_rows, written

BLOCK_ROWS, QUERY_ROWS = 4096, 1024
FIRST_DEPTH = 1
#: Groups of candidate blocks, at least, if there are as many blocks; a query block is copied once to each.
GROUPS = 24
#: Most bytes of a group, which one task holds at a time; a larger table has more groups.
GROUP_BYTES = 128 << 20
BLOCK = "block long, dims int, ids binary, vectors binary, lists binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null for vectors that take no part."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), whole)


def _narrow(values: np.ndarray) -> np.ndarray:
    """The values in the smallest integers that hold them."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return values.astype(kind)
    return values


def _integers(data: bytes, rows: int, columns: int) -> np.ndarray:
    """Integers of any width, which their bytes and number tell."""
    width = len(data) // (rows * columns) if rows * columns else 8
    return np.frombuffer(data, f"i{width}").reshape(rows, columns)


def pack_blocks(vectors: DataFrame, rows: int, with_lists: bool) -> DataFrame:
    """Rows of (vec_id, v) in blocks, without a shuffle."""

    def block(number: int, ids: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        made = np.zeros((len(ids), int(lengths.max())), np.int64)
        made[np.arange(made.shape[1]) < lengths[:, None]] = values
        made = _narrow(made)
        lists = b""
        if with_lists:
            # ~x falls as x rises, in any width.
            order = np.argsort(np.ascontiguousarray(~made.T), axis=1, kind="stable")
            lists = _narrow(order).tobytes()
        row = {
            "block": number, "dims": made.shape[1], "ids": ids.tobytes(), "vectors": made.tobytes(),
            "lists": lists,
        }
        return pa.RecordBatch.from_pylist([row], schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids = lengths = values = np.empty(0, np.int64)
        for batch in batches:
            v = batch.column(batch.schema.get_field_index("v"))
            more = (
                batch.column(batch.schema.get_field_index("vec_id")), v.value_lengths(), v.flatten()
            )
            ids, lengths, values = (
                np.concatenate([old, new.to_numpy(zero_copy_only=False).astype(np.int64)])
                for old, new in zip((ids, lengths, values), more, strict=True)
            )
            while len(ids) >= rows:
                end = int(lengths[:rows].sum())
                yield block(number, ids[:rows], lengths[:rows], values[:end])
                number, ids, lengths, values = number + 1, ids[rows:], lengths[rows:], values[end:]
        if len(ids):
            yield block(number, ids, lengths, values)

    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    schema = pa.schema(list(zip([f.split()[0] for f in BLOCK.split(", ")], kinds, strict=True)))
    return vectors.mapInArrow(run, BLOCK)


class Candidates:
    """A block's vectors and the values of its lists at growing depths."""

    def __init__(self, dims: int, ids: bytes, vectors: bytes, lists: bytes) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.exact = _integers(vectors, len(self.ids), dims)
        self.lists = _integers(lists, dims, len(self.ids))
        self.depths, depth = [], FIRST_DEPTH
        while depth < len(self.ids):
            self.depths.append(depth)
            depth *= 4
        at = np.asarray(self.depths, np.int64)
        # What the lists show next at each depth, from the top and from the bottom.
        self.next_high, self.next_low = self.shown(at), self.shown(len(self.ids) - 1 - at)
        self.high, self.low = self.shown(np.array([0]))[:, 0], self.shown(np.array([-1]))[:, 0]
        whole = self.exact.astype(np.float64)
        self.longest = float(np.sqrt(np.einsum("ij,ij->i", whole, whole).max(initial=0)))

    def shown(self, at: np.ndarray) -> np.ndarray:
        """Every list's values at some places."""
        return self.exact[self.lists[:, at], np.arange(len(self.lists))[:, None]].astype(np.float64)

    def seen(self, queries: np.ndarray, start: int, depth: int) -> np.ndarray:
        """Which rows some list shows from ``start`` to ``depth``, read from the ends the queries favour."""
        rows = np.zeros(len(self.ids), bool)
        rows[self.lists[(queries > 0).any(axis=0), start:depth]] = True
        rows[self.lists[(queries < 0).any(axis=0), len(self.ids) - depth : len(self.ids) - start]] = True
        return rows


class Best:
    """The k best candidates of one query so far."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.ids = k, np.empty(0, np.int64), np.empty(0, np.int64)


class Board:
    """The best of many queries side by side; NONE stands for places that are still free."""

    NONE = np.iinfo(np.int64).min + 1

    def __init__(self, best: list[Best]) -> None:
        self.best, self.k = best, best[0].k
        self.scores = np.full((len(best), self.k), self.NONE)
        self.ids = np.zeros((len(best), self.k), np.int64)
        for i, b in enumerate(best):
            self.scores[i, : len(b.scores)], self.ids[i, : len(b.ids)] = b.scores, b.ids
        self.changed = np.zeros(len(best), bool)

    def bound(self) -> np.ndarray:
        return self.scores[:, -1]

    def add(self, asked: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Scores of the queries numbered ``asked`` with rows of rising ids; those below NONE do not count."""
        k = self.k
        limit = self.bound()[asked].astype(scores.dtype)
        hits = scores >= limit[:, None]
        if scores.shape[1] > k and np.count_nonzero(hits) > 2 * k * len(asked):
            kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
            limit = np.maximum(limit, kth)
            hits = scores >= limit[:, None]
            if np.count_nonzero(hits) > 2 * k * len(asked):
                ties = scores == limit[:, None]
                hits &= ~ties | (np.cumsum(ties, axis=1, dtype=np.int32) <= k)  # the smallest ids
        at, column = np.divmod(np.flatnonzero(hits), hits.shape[1])
        if not len(at):
            return
        counts = np.bincount(at, minlength=len(asked))
        touched, counts = asked[counts > 0], k + counts[counts > 0]
        owner = np.concatenate([np.repeat(touched, k), asked[at]])
        found = np.concatenate([self.scores[touched].ravel(), scores[at, column].astype(np.int64)])
        names = np.concatenate([self.ids[touched].ravel(), ids[column]])
        order = np.lexsort((names, -found, owner))
        # Every touched query has at least k entries, free places included.
        first = np.cumsum(counts) - counts
        kept = order[first[:, None] + np.arange(k)]
        self.scores[touched], self.ids[touched] = found[kept], names[kept]
        self.changed[touched] = True

    def give_back(self) -> None:
        taken = np.count_nonzero(self.scores > self.NONE, axis=1)
        for i in np.flatnonzero(self.changed):
            self.best[i].scores, self.best[i].ids = self.scores[i, : taken[i]], self.ids[i, : taken[i]]


def threshold_search(
    query_ids: np.ndarray, queries: np.ndarray, block: Candidates, best: list[Best]
) -> int:
    """Bring a block's candidates into the best of every query; returns how many were scored.

    Queries read the lists together: a row that the lists show to one of them is scored for all that still read.
    """
    dims = max(queries.shape[1], block.exact.shape[1])
    if queries.shape[1] < dims or block.exact.shape[1] < dims:
        shared = min(queries.shape[1], block.exact.shape[1])
        queries = queries[:, :shared]
        if block.exact.shape[1] > shared:
            block = Candidates(
                shared, block.ids.tobytes(), np.ascontiguousarray(block.exact[:, :shared]).tobytes(),
                np.ascontiguousarray(block.lists[:shared]).tobytes(),
            )
    whole = queries.astype(np.float64)
    up, down = np.maximum(whole, 0), np.minimum(whole, 0)
    most = up @ block.high + down @ block.low
    bounds = up @ block.next_high + down @ block.next_low
    # Sums of products are exact in floats up to 2**24 and in doubles up to 2**53.
    widest = max(np.abs(block.high).max(initial=0), np.abs(block.low).max(initial=0))
    largest = np.abs(whole).max(initial=0) * widest * max(1, dims)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    # No score is above the product of the lengths, so no query stops at a depth whose bound is.
    reach = np.sqrt(np.einsum("ij,ij->i", whole, whole)) * block.longest * (1 + 1e-9)
    most = np.minimum(most, reach)
    if kind is np.int64:
        most[:] = bounds[:] = reach[:] = np.inf  # rounded bounds prove nothing
    own = np.iinfo(np.int64).min if kind is np.int64 else -np.inf
    board = Board(best)
    asked, vectors = queries.astype(kind), block.exact.astype(kind)
    reading = np.flatnonzero(most >= board.bound())
    done, start, scored = np.zeros(len(block.ids), bool), 0, 0
    for level in range(len(block.depths) + 1):
        if not len(reading):
            break
        if level < len(block.depths):
            if not (bounds[reading, level] <= reach[reading]).any():
                continue
            new = np.flatnonzero(block.seen(queries[reading], start, block.depths[level]) & ~done)
            start = block.depths[level]
        else:
            new = np.flatnonzero(~done)  # the lists are read to their end
        done[new] = True
        new = new[np.argsort(block.ids[new], kind="stable")]
        ids = block.ids[new]
        scores = asked[reading] @ vectors[new].T
        mine = np.flatnonzero(np.isin(ids, query_ids[reading]))
        at, column = np.nonzero(query_ids[reading][:, None] == ids[mine])
        scores[at, mine[column]] = own
        scored += scores.size - len(at)
        board.add(reading, ids, scores)
        if done.all():
            break
        if level < len(block.depths):
            reading = reading[bounds[reading, level] >= board.bound()[reading]]
    board.give_back()
    return scored


def _search(k: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ids, queries, best = None, None, None, []

        def found() -> pa.RecordBatch:
            kept = [b for b in best if len(b.ids)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(ids, [len(b.ids) for b in best])),
                    pa.array(np.concatenate([b.ids for b in kept] or [np.empty(0, np.int64)])),
                    pa.array(np.concatenate([b.scores for b in kept] or [np.empty(0, np.int64)])),
                ],
                ["query_id", "vec_id", "score"],
            )

        names = ("query_block", "query_dims", "query_ids", "query_vectors", "dims", "ids", "vectors", "lists")
        for q_block, q_dims, q_ids, q_vectors, dims, c_ids, vectors, lists in arrow_rows(batches, *names):
            if q_block != current:
                if current is not None:
                    yield found()
                current, ids = q_block, np.frombuffer(q_ids, np.int64)
                queries = _integers(q_vectors, len(ids), q_dims)
                best = [Best(k) for _ in ids]
            threshold_search(ids, queries, Candidates(dims, c_ids, vectors, lists), best)
        if current is not None:
            yield found()

    return run


def in_groups(candidates: DataFrame, least: int, most_bytes: int) -> tuple[DataFrame, int]:
    """Blocks with the number of their group, neighbours together, and the number of groups.

    Only the number of blocks of every partition and the size of its largest, in the widest integers, reach the driver.
    """
    size = F.octet_length("ids") * (F.lit(2) + 3 * F.col("dims").cast("long")) / 2
    parts = sorted(
        map(
            tuple,
            candidates.groupBy(F.shiftright("block", 32).alias("part"))
            .agg(F.count(F.lit(1)), F.max(size))
            .collect(),
        )
    )
    total, largest = sum(n for _, n, _ in parts), max((b for _, _, b in parts), default=0)
    together = max(1, int(most_bytes // max(1, largest)))
    groups = max(1, min(least, total), -(-total // together))
    firsts, first = [], 0
    for part, n, _ in parts:
        firsts.append((part, first))
        first += n
    places = candidates.sparkSession.createDataFrame(firsts, "part long, first long")
    number = F.col("first") + F.col("block").bitwiseAND(F.lit((1 << 32) - 1))
    numbered = candidates.withColumn("part", F.shiftright("block", 32)).join(F.broadcast(places), "part")
    group = F.floor(number * F.lit(groups) / F.lit(max(1, total)))
    return numbered.withColumn("group", F.least(group, F.lit(groups - 1)).cast("int")).drop("part", "first"), groups


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    scale: int = 64,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    groups: int = GROUPS,
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows for every row that ``queries`` selects.

    ``vectors`` has vec_id and embedding.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("v")
    ).where("vec_id IS NOT NULL AND v IS NOT NULL")
    candidates = written(pack_blocks(rows, block_rows, True), "topk-candidates")
    grouped, groups = in_groups(candidates, groups, group_bytes)
    asked = written(pack_blocks(rows.where(queries), query_rows, False), "topk-queries")
    asked = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.col("block").alias("query_block"), F.col("dims").alias("query_dims"),
        F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"),
    )
    # A merge join sorts with spilling and holds one group at a time, also where a task has several.
    found = asked.join(grouped.hint("merge"), "group").drop("group", "block").mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
