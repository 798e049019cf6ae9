"""Near-duplicate classes by BagMinHash signatures of weighted word shingles.

The weight of a shingle is how often it occurs. Weights are discretised to whole numbers and cut into
dyadic intervals [0, 1), [1, 2), [2, 4), [4, 8), ... Each pair of shingle and interval is a Poisson process
whose rate is the interval's length; its points carry a time, a component of the signature and a place in
the interval, and count for a document when that place lies below its weight. The signature holds the
earliest time of every component, so two components agree with the probability of the weighted Jaccard
similarity. Points are made in order of time and only up to a limit by which all components have one, so a
long document costs about as much as a short one.

Texts with the same shingles are one node. Bands of the signature put nodes into buckets. The node of a
bucket that shares most buckets is its hub, and all others are compared with it. Whatever has a hub in
common and is then in different components is compared block by block by signature, and pairs that may
reach the threshold are verified by the exact overlap of their multisets, unless their components have
been joined meanwhile. No pair is left out because a bucket is large: a hub of too many blocks is first
split by bands that lie across the others.

Defined cases: words are runs of letters and digits in lower case; a text of one to four words is one
shingle; a text without words (null, empty) is in a class of its own; equal rows and null ids are separate
rows of one class, of which exactly one is kept; no rows give no rows. Input columns named like a result
column are replaced by it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from catkeep.llm.common import arrow_rows, discard, keep_but, scratch_count, written
from catkeep.llm.components import components
from catkeep.llm.url_filter import broadcast_blocks, with_possible
from catkeep.operators.outcomes import id_filter

RESULT = ("class_id", "class_size", "kept")
SHINGLE, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with a probability below 3 in a million; in hubs that are split,
#: where it has to share one of the other bands too, it is missed with a probability below 6 in a million.
BANDS, ROWS = 42, 6
SIZE = BANDS * ROWS
#: Estimates lie more than five standard errors below the threshold before a pair is passed over.
LEAST_ESTIMATE = 0.67
BLOCK_NODES, BLOCK_WORDS = 256, 400_000
#: A hub of more blocks is split by other bands of the signature.
MOST_BLOCKS = 32
#: Bits of the filter in front of the texts' shuffle (1 MB): beyond a few million nodes with a partner it lets
#: more and more texts through, and in the end all.
TEXT_FILTER_BITS = 1 << 23
DOCS_AT_ONCE, POINTS_AT_ONCE = 400, 1 << 18
WORD = re.compile(r"[^\W_]+")
SIGNED = "_row long, _node binary, _weight long, _sig binary"

_U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def weighted_shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the text, hash and count of every distinct shingle, in order of text and hash."""
    words = [WORD.findall(t.lower()) for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.array([w for ws in words for w in ws], dtype=object)
    if not len(flat):
        return np.empty(0, np.int64), np.empty(0, _U), np.empty(0, np.int64)
    hashes = pd.util.hash_array(flat, categorize=True)
    of = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    # A shingle starts where enough words follow, or at the start of a shorter text.
    place = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    count = np.repeat(sizes, sizes)
    starts = np.flatnonzero((place + size <= count) | ((place == 0) & (count < size)))
    shingles = np.zeros(len(starts), _U)
    for i in range(size):
        at = starts + i
        inside = place[starts] + i < count[starts]
        word = np.where(inside, hashes[np.minimum(at, len(flat) - 1)], _U(0))
        shingles = mixed(shingles * _U(0x9E3779B97F4A7C15) + word + _U(i + 1))
    texts_of = of[starts]
    order = np.lexsort((shingles, texts_of))
    texts_of, shingles = texts_of[order], shingles[order]
    new = np.ones(len(order), bool)
    new[1:] = (texts_of[1:] != texts_of[:-1]) | (shingles[1:] != shingles[:-1])
    first = np.flatnonzero(new)
    return texts_of[first], shingles[first], np.diff(np.append(first, len(order)))


def signatures(
    texts: int, of: np.ndarray, shingles: np.ndarray, weights: np.ndarray, size: int = SIZE
) -> np.ndarray:
    """Earliest time of each component for ``texts`` weighted sets; infinite where a set is empty."""
    signature = np.full(texts * size, np.inf)
    total = np.bincount(of, weights, texts)
    limit = size * (np.log(size) + 3) / np.maximum(total, 1)
    # One process per shingle and dyadic interval that begins below the weight.
    parts, low, length = [], 0, 1
    while len(at := np.flatnonzero(weights > low)):
        parts.append((at, np.full(len(at), low), np.full(len(at), length)))
        low, length = low + length, max(1, low + length)
    if not parts:
        return signature.reshape(texts, size)
    element, low, length = (np.concatenate(x) for x in zip(*parts, strict=True))
    text, weight = of[element], weights[element]
    seed = mixed(shingles[element] + mixed(low.astype(_U) + _U(1)))
    time, point = np.zeros(len(seed)), np.zeros(len(seed), _U)
    active = np.arange(len(seed))
    while len(active):
        late = []
        while len(active):
            ahead = int(np.clip(POINTS_AT_ONCE // len(active), 1, 256))
            waits, slices = [], range(0, len(active), POINTS_AT_ONCE)
            for a in slices:
                waits.append(_points(active[a : a + POINTS_AT_ONCE], ahead, seed, point, time, length, low, weight, text, limit, signature, size))
            going = np.concatenate(waits)
            late.append(active[~going])
            active = active[going]
        # Where a component is still without a point, go on to twice the limit.
        open_texts = np.isinf(signature).reshape(texts, size).any(axis=1) & (total > 0)
        waiting = np.concatenate(late)
        active = waiting[open_texts[text[waiting]]]
        limit = np.where(open_texts, limit * 2, limit)
    return signature.reshape(texts, size)


def _points(which, ahead, seed, point, time, length, low, weight, text, limit, signature, size) -> np.ndarray:
    """The next ``ahead`` points of some processes; which of these have not come to their limit.

    The last point made for a process is the first beyond its limit; it is made again if the limit grows.
    """
    number = point[which][:, None] + np.arange(1, ahead + 1, dtype=_U)[None, :]
    first = mixed(seed[which][:, None] + number * _U(0x9E3779B97F4A7C15))
    second = mixed(first + _U(0xD1B54A32D192ED03))
    waits = -np.log(((first >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53) / length[which][:, None]
    waits[:, 0] += time[which]
    at = np.cumsum(waits, axis=1)
    good = at <= limit[text[which]][:, None]
    made = good.sum(axis=1)
    rows, columns = np.nonzero(good)
    chosen, drawn = which[rows], second[rows, columns]
    place = low[chosen] + length[chosen] * ((drawn >> _U(32)).astype(np.float64) * 2.0**-32)
    counts = place < weight[chosen]
    component = ((drawn & _U(0xFFFFFFFF)) % _U(size)).astype(np.int64)
    np.minimum.at(signature, text[chosen[counts]] * size + component[counts], at[rows, columns][counts])
    point[which] += made.astype(_U)
    some = made > 0
    time[which[some]] = at[some, made[some] - 1]
    return made == ahead


def short_signature(times: np.ndarray) -> np.ndarray:
    """16 bits of every component, enough to tell whether components agree."""
    return (mixed(times.view(_U)) >> _U(48)).astype(np.uint16)


def sign(documents: DataFrame, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """Row number, node, weight and signature beside the columns of ``documents``."""
    schema = StructType([*documents.schema.fields, *StructType.fromDDL(SIGNED).fields])
    at = documents.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        for whole in batches:
            for a in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(a, DOCS_AT_ONCE)
                texts = [t or "" for t in batch.column(at).to_pylist()]
                of, hashes, counts = weighted_shingles(texts, shingle)
                short = short_signature(signatures(len(texts), of, hashes, counts, size))
                edges = np.searchsorted(of, np.arange(len(texts) + 1))
                nodes, sigs = [], []
                for i, (x, y) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
                    content = hashes[x:y].tobytes() + counts[x:y].tobytes()
                    nodes.append(hashlib.blake2b(content, digest_size=16).digest() if y > x else None)
                    sigs.append(short[i].tobytes() if y > x else None)
                weights = np.bincount(of, counts, len(texts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns, pa.array(np.arange(row, row + len(texts))),
                        pa.array(nodes, pa.binary()), pa.array(weights), pa.array(sigs, pa.binary()),
                    ],
                    [*batch.schema.names, "_row", "_node", "_weight", "_sig"],
                )
                row += len(texts)

    return documents.mapInArrow(run, schema)


def _band_keys(sigs: np.ndarray, bands: int, across: bool = False) -> np.ndarray:
    """A key per band; ``across`` forms bands of components that lie in different bands otherwise."""
    if across:
        parts = sigs.reshape(len(sigs), -1, bands).transpose(0, 2, 1).astype(_U)
    else:
        parts = sigs.reshape(len(sigs), bands, -1).astype(_U)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), parts.shape[:2])
    for i in range(parts.shape[2]):
        keys = mixed(keys * _U(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def band_rows(nodes: DataFrame, bands: int = BANDS, across: bool = False) -> DataFrame:
    """One row per node and band: key, band, node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
                keys = _band_keys(sigs.reshape(batch.num_rows, -1), bands, across)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view(np.int64)),
                        pa.array(np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)),
                        batch.column(0).take(pa.array(np.repeat(np.arange(batch.num_rows), bands))),
                    ],
                    ["key", "band", "node"],
                )

    return nodes.select("node", "sig").mapInArrow(run, "key long, band int, node binary")


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float, least: float) -> DataFrame:
    """Pairs (u, v) whose weights and signatures allow the threshold."""
    for side in "uv":
        pairs = pairs.join(
            nodes.select(
                F.col("node").alias(side), F.col("weight").alias(f"{side}_weight"), F.col("sig").alias(f"{side}_sig")
            ),
            side,
        )
    near = pairs.where(
        F.least("u_weight", "v_weight") >= threshold * F.greatest("u_weight", "v_weight")
    ).select("u", "v", "u_sig", "v_sig")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                u, v = (
                    np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for i in (2, 3)
                )
                good = pa.array((u == v).mean(axis=1) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(good)

    return near.mapInArrow(run, "u binary, v binary")


def similarity(left: tuple, right: tuple) -> float:
    """Weighted Jaccard similarity of two multisets of (sorted hashes, counts)."""
    _, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(left[1][a], right[1][b]).sum())
    return shared / max(1, int(left[1].sum()) + int(right[1].sum()) - shared)


def multisets(texts: list[str], shingle: int) -> list[tuple]:
    of, hashes, counts = weighted_shingles(texts, shingle)
    edges = np.searchsorted(of, np.arange(len(texts) + 1))
    return [(hashes[x:y], counts[x:y]) for x, y in zip(edges[:-1], edges[1:], strict=True)]


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Pairs whose multisets of shingles overlap enough."""
    for side in "uv":
        pairs = pairs.join(texts.select(F.col("node").alias(side), F.col("text").alias(f"{side}_text")), side)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, DOCS_AT_ONCE // 2):
                batch = whole.slice(a, DOCS_AT_ONCE // 2)
                n = batch.num_rows
                sets = multisets(batch.column(2).to_pylist() + batch.column(3).to_pylist(), shingle)
                good = [similarity(sets[i], sets[n + i]) >= threshold for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1)], ["u", "v"]
                ).filter(pa.array(good, pa.bool_()))

    return pairs.select("u", "v", "u_text", "v_text").mapInArrow(run, "u binary, v binary")


def _blocks_needed(block_nodes: int, block_words: int) -> Column:
    return F.ceil(F.greatest(F.col("n") / block_nodes, F.col("words") / block_words)).cast("int")


def _mixed_hubs(members: DataFrame, block_nodes: int, block_words: int) -> DataFrame:
    """Hubs whose nodes are in different components, with the number of blocks for these."""
    totals = members.groupBy("hub").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"),
        F.count(F.lit(1)).alias("n"), F.sum("weight").alias("words"),
    )
    return totals.where("low <> high").select("hub", _blocks_needed(block_nodes, block_words).alias("blocks"))


def split_hubs(
    around: DataFrame, comp: DataFrame, bands: int, block_nodes: int, block_words: int, most_blocks: int
) -> DataFrame:
    """hub, node, comp, weight and sig of all members; hubs of too many blocks are split by other bands.

    Pairs of blocks grow with the square of a hub's nodes. Two nodes at the threshold share a band across
    the first ones as surely as one of these, so a large hub's nodes are dealt into the groups that share
    one. Such a group is compared in pairs of blocks, whatever its size.
    """
    placed = around.join(comp, "node")
    large = _mixed_hubs(placed, block_nodes, block_words).where(F.col("blocks") > most_blocks)
    large = written(large.select("hub"), "near-large")
    if not large.head(1):
        return placed
    inside = around.join(large, "hub", "left_semi")
    nodes = comp.join(inside.select("node").distinct(), "node", "left_semi")
    keys = band_rows(nodes, bands, across=True).select("node", "key")
    group = F.unhex(F.md5(F.concat("hub", F.encode(F.col("key").cast("string"), "UTF-8")))).alias("hub")
    dealt = written(inside.join(keys, "node").select(group, "node"), "near-dealt")
    return placed.join(large, "hub", "left_anti").unionByName(dealt.join(comp, "node"))


def _block_pairs(members: DataFrame, block_nodes: int, block_words: int) -> DataFrame:
    """Pairs of blocks of every hub's nodes, where these are still in different components.

    A block has a bounded number of nodes and, but for single long texts, of words, so a large group
    becomes many rows over many tasks.
    """
    mixed_hubs = _mixed_hubs(members, block_nodes, block_words)
    placed = members.join(mixed_hubs, "hub").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    # Dealt anew by block: else the layout by hub would be kept, with all nodes of a hub in one task.
    blocks = placed.repartition("hub", "block").groupBy("hub", "blocks", "block").agg(
        F.collect_list(F.struct("node", "comp", "weight", "sig")).alias("nodes")
    )
    left = blocks.withColumn("other", F.explode(F.sequence("block", F.col("blocks") - 1)))
    right = blocks.select("hub", F.col("block").alias("other"), F.col("nodes").alias("others"))
    alone = left.where("other = block").withColumn("others", F.array().cast(blocks.schema["nodes"].dataType))
    pairs = left.where("other > block").join(right, ["hub", "other"])
    columns = ["hub", "block", "other", "nodes", "others"]
    return alone.select(*columns).unionByName(pairs.select(*columns))


TASK = "hub binary, block int, other int, nodes array<binary>, comps array<binary>, us array<int>, vs array<int>"


def _tasks(pairs: DataFrame, threshold: float, least: float) -> DataFrame:
    """What is to be verified of each pair of blocks: nodes, and pairs of these by position.

    Pairs are of different components, likely ones first.
    """
    schema = to_arrow_schema(StructType.fromDDL(TASK))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for hub, block, other, nodes, others in arrow_rows(batches, "hub", "block", "other", "nodes", "others"):
            both = nodes + others
            comp = pd.factorize(np.array([n["comp"] for n in both], dtype=object))[0]
            weight = np.array([n["weight"] for n in both], np.float64)
            sig = np.frombuffer(b"".join(n["sig"] for n in both), np.uint16).reshape(len(both), -1)
            rows, us, vs, near = range(len(nodes)), [], [], []
            for i in rows:
                to = np.arange(i + 1, len(nodes)) if not others else np.arange(len(nodes), len(both))
                to = to[comp[to] != comp[i]]
                to = to[np.minimum(weight[to], weight[i]) >= threshold * np.maximum(weight[to], weight[i])]
                if len(to):
                    share = (sig[to] == sig[i]).mean(axis=1)
                    good = share >= least
                    us.append(np.full(int(good.sum()), i))
                    vs.append(to[good])
                    near.append(share[good])
            us, vs = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (us, vs))
            if not len(us):
                continue
            order = np.argsort(-np.concatenate(near), kind="stable")
            used, place = np.unique(np.concatenate([us[order], vs[order]]), return_inverse=True)
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "hub": hub, "block": block, "other": other,
                        "nodes": [both[i]["node"] for i in used], "comps": [both[i]["comp"] for i in used],
                        "us": place[: len(us)].tolist(), "vs": place[len(us) :].tolist(),
                    }
                ],
                schema,
            )

    return pairs.mapInArrow(run, TASK)


def _joined(tasks: DataFrame, texts: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """Links between components, found by exact overlap; pairs that are joined by then are passed over."""
    key = ["hub", "block", "other"]
    needed = tasks.select(*key, F.posexplode("nodes").alias("place", "node")).join(texts, "node")
    gathered = needed.groupBy(*key).agg(F.collect_list(F.struct("place", "text")).alias("texts"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nodes, comps, us, vs, found in arrow_rows(batches, "nodes", "comps", "us", "vs", "texts"):
            held = [t["text"] for t in sorted(found, key=lambda t: t["place"])]
            sets = multisets(held, shingle)
            parent = {c: c for c in comps}

            def root(c: bytes, parent: dict = parent) -> bytes:
                while parent[c] != c:
                    parent[c] = c = parent[parent[c]]
                return c

            links = []
            for u, v in zip(us, vs, strict=True):
                a, b = root(comps[u]), root(comps[v])
                if a != b and similarity(sets[u], sets[v]) >= threshold:
                    parent[a] = b
                    links.append((nodes[u], nodes[v]))
            if links:
                columns = [pa.array(x, pa.binary()) for x in zip(*links, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

    return (
        tasks.join(gathered, key).select("nodes", "comps", "us", "vs", "texts").mapInArrow(run, "u binary, v binary")
    )


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct()


def _possible(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key may be among ``keys``, a written table without repeats."""
    return with_possible(rows, keys, key, broadcast_blocks(keys.count())).where("possible").drop("possible")


def linked_nodes(
    signed: DataFrame,
    bands: int, threshold: float, least: float, shingle: int,
    block_nodes: int = BLOCK_NODES, block_words: int = BLOCK_WORDS, most_blocks: int = MOST_BLOCKS,
) -> DataFrame:
    """node and comp of every node with a link; ``signed`` has _node, _weight, _sig and text."""
    nodes = written(
        signed.where("_node IS NOT NULL")
        .groupBy(F.col("_node").alias("node"))
        .agg(F.first("_weight").alias("weight"), F.first("_sig").alias("sig")),
        "near-nodes",
    )
    rows = band_rows(nodes, bands).select("key", "node")
    shared = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-shared")
    # Rows of keys that surely no other node has, and then nodes without a partner, stay out of the shuffles.
    members = written(_possible(rows, shared, "key").join(shared, "key"), "near-members")
    degree = written(members.groupBy("node").agg(F.sum("n").alias("degree")), "near-degrees")
    partners = written(_possible(nodes, degree, "node").join(degree, "node"), "near-partners")
    # A filter of fixed size keeps most texts that no other is compared with out of the shuffle; the join decides.
    texts = written(
        signed.select(F.col("_node").alias("node"), "text")
        .where(F.col("node").isNotNull() & id_filter(partners, "node", TEXT_FILTER_BITS))
        .join(partners.select("node"), "node", "left_semi")
        .groupBy("node")
        .agg(F.first("text").alias("text")),
        "near-texts",
    )
    # First the hub of every bucket: the node that shares most buckets, often what others were copied from.
    ranked = members.join(partners.select("node", "degree"), "node")
    hubs = ranked.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("hub"))
    around = written(
        members.join(hubs, "key").select(F.col("hub.node").alias("hub"), "node").distinct(), "near-hubs"
    )
    stars = _ordered(around.select(F.col("node").alias("u"), F.col("hub").alias("v")))
    near = written(_estimated(stars, partners, threshold, least), "near-stars")
    links = written(_verified(near, texts, threshold, shingle), "near-links")
    first = written(components(links), "near-components")
    # Then whatever shares a bucket, and so its hub, but is in different components, block by block.
    comp = partners.select("node", "weight", "sig").join(first, "node", "left").withColumn(
        "comp", F.coalesce("comp", "node")
    )
    placed = split_hubs(around, comp, bands, block_nodes, block_words, most_blocks)
    tasks = written(_tasks(_block_pairs(placed, block_nodes, block_words), threshold, least), "near-tasks")
    more = written(_joined(tasks, texts, threshold, shingle), "near-links")
    if not more.head(1):
        return first
    # Links found for parts of a component join the whole of it.
    return written(components(links.unionByName(more)), "near-components")


def near_duplicates(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    shingle: int = SHINGLE,
    least_estimate: float = LEAST_ESTIMATE,
) -> DataFrame:
    """All rows of ``documents`` (doc_id, text) with class_id, class_size and whether the row is kept.

    A class is a connected component of the pairs that reach the threshold; its id is its smallest
    doc_id, and that row is kept.
    """
    # Other columns are held under names that none of the operator's own has.
    names = [c for c in documents.columns if c not in RESULT]
    held = [c if c in ("doc_id", "text") else f"input_{i}" for i, c in enumerate(names)]
    docs = documents.select(
        *[c.alias(h) for c, h in zip(keep_but(documents, RESULT), held, strict=True)]
    ).withColumns(
        {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")}
    )
    before = scratch_count()
    signed = written(sign(docs, bands * rows, shingle), "near-signed")
    linked = linked_nodes(signed, bands, threshold, least_estimate, shingle)
    # Rows go through the grouping by number and id; their other columns are read once more at the end.
    kept = signed.select("doc_id", "_row", "_node")
    inside = kept.where("_node IS NOT NULL").join(
        linked.withColumnRenamed("node", "_node").withColumnRenamed("comp", "_comp"), "_node", "left"
    ).withColumn("_comp", F.coalesce("_comp", "_node"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("_row").alias("row"))
    classes = inside.groupBy("_comp").agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("class_size"))
    found = inside.join(classes.where("class_size > 1"), "_comp").select(
        "_row",
        F.col("_first.doc_id").alias("class_id"),
        "class_size",
        (F.col("_row") == F.col("_first.row")).alias("kept"),
    )
    judged = written(found, "near-classes")
    # What is left to read are the signed rows and the classes of several rows.
    discard(signed.sparkSession, before + 1, -1)
    alone = {"class_id": F.col("doc_id"), "class_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    # Rows that are surely in none of these are not shuffled.
    rows = with_possible(signed.drop("_sig", "_weight", "_node"), judged, "_row", broadcast_blocks(judged.count()))
    several = rows.where("possible").join(judged, "_row", "left")
    several = several.withColumns(
        {c: F.when(F.col("class_size").isNull(), v).otherwise(F.col(c)) for c, v in alone.items()}
    )
    shown = [*[F.col(h).alias(c) for c, h in zip(names, held, strict=True)], *RESULT]
    return several.unionByName(rows.where("NOT possible").withColumns(alone)).select(*shown)
