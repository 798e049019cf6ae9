"""Toxicity scores by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of its hashed word vector and of the vectors of its character 3- to 5-grams; what
the network's input weights make of it is computed once per distinct word. Every text is scored whole, in
overlapping windows; its score is that of its worst window. Training takes the worst window of
each document as the current model sees it, so that a label of the document teaches the place.

The network is fitted on the driver, on a bounded sample: at most ``sample`` documents of each class, those
with the least hash of their id, and of at most ``max_chars`` characters. Everything else runs in tasks.

Defined cases: a null or empty text is one empty window and gets a score like any other; repeated rows and
null ids are scored row by row; without labels of both classes every text gets the smoothed share of
toxic labels; no rows give no rows. Input columns named like a result column are replaced by it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from catkeep.llm.common import keep_but

RESULT = ("score", "predicted")
SAMPLE, MAX_CHARS = 1600, 100_000
WINDOW, STRIDE = 64, 48
WORD_BUCKETS, GRAM_BUCKETS, WIDTH, HIDDEN, ATTENTION = 1 << 14, 1 << 16, 8, 8, 8
EPOCHS, WARM_EPOCHS, BATCH, RATE = 14, 4, 128, 0.01
#: Words a worker remembers with their inputs; the memory is started anew beyond that.
REMEMBERED = 200_000
WINDOWS_AT_ONCE, DOCS_AT_ONCE, WORDS_AT_ONCE = 2048, 500, 20_000
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of each word; buckets of all character n-grams and where each word's begin."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))
    rolled = np.zeros(len(codes), np.uint64)
    grams, owners = [], []
    prime = np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, 6):
        ahead = np.zeros(len(codes), np.uint64)
        ahead[: max(0, len(codes) - n + 1)] = codes[n - 1 :]
        rolled = _mix(rolled * prime + ahead + np.uint64(n))
        if n >= 3:
            whole = left >= n
            grams.append(rolled[whole] % np.uint64(GRAM_BUCKETS))
            owners.append(of[whole])
    # A word of one letter has a single gram; that of an empty one is its marks.
    owners.append(np.flatnonzero(sizes < 3))
    grams.append(rolled[np.cumsum(sizes) - sizes][sizes < 3] % np.uint64(GRAM_BUCKETS))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    gram = np.concatenate(grams)[order].astype(np.int64)
    whole_word = np.zeros(len(words), np.uint64)
    np.add.at(whole_word, of, _mix(codes * prime + (np.arange(len(codes)) - (np.cumsum(sizes) - sizes)[of]).astype(np.uint64)))
    return (_mix(whole_word) % np.uint64(WORD_BUCKETS)).astype(np.int64), gram, np.searchsorted(owner[order], np.arange(len(words)))


def window_starts(words: int) -> range:
    """Starts of overlapping windows that cover all words; one for no words."""
    return range(0, max(1, words - (WINDOW - STRIDE)), STRIDE)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights, with the forward pass over windows of word inputs."""

    weights: dict[str, np.ndarray]
    shift: float = 0.0

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            {
                "word": draw(WORD_BUCKETS, WIDTH, scale=0.1),
                "gram": draw(GRAM_BUCKETS, WIDTH, scale=0.1),
                "in": draw(2 * WIDTH, 6 * HIDDEN, scale=0.3),
                "bias": np.zeros(6 * HIDDEN, np.float32),
                "forth": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
                "back": draw(HIDDEN, 3 * HIDDEN, scale=0.3),
                "key": draw(2 * HIDDEN, ATTENTION, scale=0.3),
                "ask": draw(ATTENTION, scale=0.3),
                "out": draw(2 * HIDDEN, scale=0.3),
                "level": np.zeros(1, np.float32),
            }
        )

    def embed(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Vector of every word, word part and character part beside one another."""
        features = word_features(words)
        bucket, gram, first = features
        counts = np.diff(np.append(first, len(gram)))[:, None].astype(np.float32)
        chars = np.add.reduceat(self.weights["gram"][gram], first, axis=0) / np.sqrt(counts)
        return np.concatenate([self.weights["word"][bucket], chars], axis=1), (*features, counts)

    def inputs(self, words: list[str]) -> np.ndarray:
        """What the gates get from every word; a slice at a time, as n-grams take memory."""
        made = [
            self.embed(words[a : a + WORDS_AT_ONCE])[0] @ self.weights["in"] + self.weights["bias"]
            for a in range(0, len(words), WORDS_AT_ONCE)
        ]
        return np.concatenate(made)

    def run(self, x: np.ndarray, mask: np.ndarray, recurrent: np.ndarray, trace: list | None = None) -> np.ndarray:
        """States after every step of one direction; x is steps by windows by gates."""
        steps, n, _ = x.shape
        state = np.zeros((n, HIDDEN), np.float32)
        states = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps):
            inner = state @ recurrent
            gates = _sigmoid(x[t, :, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            fresh = np.tanh(x[t, :, 2 * HIDDEN :] + reset * inner[:, 2 * HIDDEN :])
            moved = (1 - update) * (fresh - state) * mask[t]
            if trace is not None:
                trace.append((state, update, reset, fresh, inner[:, 2 * HIDDEN :]))
            state = state + moved
            states[t] = state
        return states

    def logits(self, x: np.ndarray, mask: np.ndarray, traces: tuple | None = None) -> tuple:
        """Logit of every window; x is steps by windows by 6 gates, mask steps by windows by 1."""
        w = self.weights
        forth = self.run(x[..., : 3 * HIDDEN], mask, w["forth"], traces and traces[0])
        back = self.run(x[::-1, :, 3 * HIDDEN :], mask[::-1], w["back"], traces and traces[1])[::-1]
        states = np.concatenate([forth, back], axis=2)
        keys = np.tanh(states @ w["key"])
        asked = (keys @ w["ask"])[..., None] + (mask - 1) * 1e4
        share = np.exp(asked - asked.max(axis=0))
        share /= share.sum(axis=0)
        pooled = (share * states).sum(axis=0)
        return pooled @ w["out"] + w["level"], states, keys, share, pooled


def _gather(table: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps-first inputs and mask of windows given by word numbers, -1 where there is no word."""
    ids = ids.T
    return table[np.maximum(ids, 0)], (ids >= 0)[..., None].astype(np.float32)


def _windows(numbers: np.ndarray) -> np.ndarray:
    """Word numbers of every window of a text, filled up with -1."""
    starts = window_starts(len(numbers))
    padded = np.full(starts[-1] + WINDOW, -1, np.int64)
    padded[: len(numbers)] = numbers
    return padded[np.asarray(starts)[:, None] + np.arange(WINDOW)]


def score_windows(net: Network, table: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Logits of windows of word numbers into ``table``, the inputs of words."""
    if not len(table):
        table = np.zeros((1, 6 * HIDDEN), np.float32)
    return np.concatenate(
        [
            net.logits(*_gather(table, windows[a : a + WINDOWS_AT_ONCE]))[0]
            for a in range(0, len(windows), WINDOWS_AT_ONCE)
        ]
    )


def _direction_gradient(net, recurrent, x_shape, trace, mask, d_states):
    """Gradients of one direction: of its inputs and of its recurrent weights."""
    d_x = np.empty(x_shape, np.float32)
    d_recurrent = np.zeros_like(net.weights[recurrent])
    d_state = np.zeros_like(trace[0][0])
    for t in range(len(trace) - 1, -1, -1):
        state, update, reset, fresh, inner = trace[t]
        d_state = d_state + d_states[t]
        d_moved = d_state * mask[t]
        d_fresh = d_moved * (1 - update) * (1 - fresh**2)
        d_update = d_moved * (state - fresh) * update * (1 - update)
        d_reset = d_fresh * inner * reset * (1 - reset)
        d_x[t] = np.concatenate([d_update, d_reset, d_fresh], axis=1)
        d_inner = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
        d_recurrent += state.T @ d_inner
        d_state = d_state - d_moved * (1 - update) + d_inner @ net.weights[recurrent].T
    return d_x, d_recurrent


def gradients(net: Network, words: list[str], windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss over windows of numbers into ``words``."""
    w = net.weights
    vectors, (bucket, gram, first, counts) = net.embed(words)
    x, mask = _gather(vectors @ w["in"] + w["bias"], windows)
    traces = ([], [])
    logit, states, keys, share, pooled = net.logits(x, mask, traces)
    d_logit = ((_sigmoid(logit) - labels) / len(labels)).astype(np.float32)
    d_pooled = d_logit[:, None] * w["out"]
    d_states = share * d_pooled
    d_share = (states * d_pooled).sum(axis=2, keepdims=True)
    d_asked = share * (d_share - (share * d_share).sum(axis=0))
    d_keys = d_asked * w["ask"] * (1 - keys**2)
    d_states = d_states + d_keys @ w["key"].T
    half = (x.shape[0], x.shape[1], 3 * HIDDEN)
    d_forth, d_recurrent = _direction_gradient(net, "forth", half, traces[0], mask, d_states[..., :HIDDEN])
    d_back, d_recurrent_back = _direction_gradient(net, "back", half, traces[1], mask[::-1], d_states[::-1, :, HIDDEN:])
    d_x = np.concatenate([d_forth, d_back[::-1]], axis=2) * mask
    d_table = np.zeros((len(words), 6 * HIDDEN), np.float32)
    np.add.at(d_table, np.maximum(windows.T, 0).ravel(), d_x.reshape(-1, 6 * HIDDEN))
    d_vectors = d_table @ w["in"].T
    d_word, d_gram = np.zeros_like(w["word"]), np.zeros_like(w["gram"])
    np.add.at(d_word, bucket, d_vectors[:, :WIDTH])
    sizes = np.diff(np.append(first, len(gram)))
    np.add.at(d_gram, gram, np.repeat(d_vectors[:, WIDTH:] / np.sqrt(counts), sizes, axis=0))
    return {
        "word": d_word, "gram": d_gram, "in": vectors.T @ d_table, "bias": d_table.sum(axis=0),
        "forth": d_recurrent, "back": d_recurrent_back,
        "key": np.tensordot(states, d_keys, ((0, 1), (0, 1))), "ask": (keys * d_asked).sum(axis=(0, 1)),
        "out": pooled.T @ d_logit, "level": d_logit.sum(keepdims=True),
    }


@dataclass
class Adam:
    rate: float = RATE
    first: dict = field(default_factory=dict)
    second: dict = field(default_factory=dict)
    steps: int = 0

    def step(self, weights: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for name, g in grads.items():
            m = self.first[name] = 0.9 * self.first.get(name, 0) + 0.1 * g
            v = self.second[name] = 0.999 * self.second.get(name, 0) + 0.001 * g * g
            lift = np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            weights[name] -= (self.rate * lift * m / (np.sqrt(v) + 1e-8)).astype(np.float32)


def fit(texts: list[str], labels: list[int], share: float | None = None, seed: int = 7) -> Network:
    """A network for labelled texts; ``share`` is the share of label 1 where it will be used."""
    y = np.asarray(labels, np.float32)
    if not len(y) or y.min() == y.max():
        share = share if share is not None else (float(y.sum()) + 0.5) / (len(y) + 2)
        net = Network.fresh(seed)
        net.weights["out"][:] = 0
        net.shift = float(np.log(share / (1 - share)))
        return net
    rng = np.random.default_rng(seed)
    numbers: dict[str, int] = {}
    windows, owner = [], []
    for i, text in enumerate(texts):
        ids = np.fromiter((numbers.setdefault(x, len(numbers)) for x in words_of(text)), np.int64)
        windows.append(_windows(ids))
        owner.append(np.full(len(windows[-1]), i))
    windows, owner = np.concatenate(windows), np.concatenate(owner)
    first = np.searchsorted(owner, np.arange(len(y)))
    count = np.diff(np.append(first, len(owner)))
    words = np.array(list(numbers) or [""], dtype=object)
    net, adam = Network.fresh(seed), Adam()
    epochs = EPOCHS * max(1, min(3, 1200 // len(y)))
    for epoch in range(epochs):
        chosen = first + (rng.random(len(y)) * count).astype(np.int64)
        others = (first + (rng.random(len(y)) * count).astype(np.int64))[y == 0]
        if epoch >= WARM_EPOCHS:
            scores = score_windows(net, net.inputs(list(words)), windows)
            order = np.lexsort((-scores, owner))
            chosen = order[first]
        rows = np.concatenate([chosen, others])
        rng.shuffle(rows)
        adam.rate = RATE * (1 if epoch < epochs * 2 // 3 else 0.3)
        for a in range(0, len(rows), BATCH):
            part = windows[rows[a : a + BATCH]]
            used, inverse = np.unique(part, return_inverse=True)
            inverse = inverse.reshape(part.shape)
            if used[0] == -1:
                used, inverse = used[1:], inverse - 1
            adam.step(
                net.weights,
                gradients(net, list(words[used]) or [""], inverse, y[owner[rows[a : a + BATCH]]]),
            )
    if share is not None:
        was = float(y.mean())
        share = min(max(share, 1e-4), 1 - 1e-4)
        net.shift = float(np.log(share / (1 - share)) - np.log(was / (1 - was)))
    return net


class Scorer:
    """Scores texts, remembering what words bring in."""

    def __init__(self, net: Network) -> None:
        self.net, self.numbers, self.table = net, {}, np.zeros((0, 6 * HIDDEN), np.float32)

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        split = [words_of(t) for t in texts]
        if len(self.numbers) > REMEMBERED:
            self.numbers, self.table = {}, self.table[:0]
        new = list(dict.fromkeys(w for ws in split for w in ws if w not in self.numbers))
        if new:
            self.numbers.update(zip(new, range(len(self.numbers), len(self.numbers) + len(new)), strict=True))
            self.table = np.concatenate([self.table, self.net.inputs(new).astype(np.float32)])
        find = self.numbers.__getitem__
        worst = np.full(len(texts), -np.inf)
        held, owners, size = [], [], 0

        def settle() -> None:
            nonlocal held, owners, size
            if held:
                logits = score_windows(self.net, self.table, np.concatenate(held))
                np.maximum.at(worst, np.repeat(owners, list(map(len, held))), logits)
            held, owners, size = [], [], 0

        for i, ws in enumerate(split):
            held.append(_windows(np.fromiter(map(find, ws), np.int64, len(ws))))
            owners.append(i)
            size += len(held[-1])
            if size >= 4 * WINDOWS_AT_ONCE:
                settle()
        settle()
        return _sigmoid(worst + self.net.shift)


def score(documents: DataFrame, net: Network) -> DataFrame:
    """All rows of ``documents`` (text) with score and predicted; nothing is shuffled."""
    rows = documents.select(*keep_but(documents, RESULT))
    at = rows.columns.index("text")
    shared = documents.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for a in range(0, whole.num_rows, DOCS_AT_ONCE):
                batch = whole.slice(a, DOCS_AT_ONCE)
                scores = scorer(batch.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], [*batch.schema.names, "score"])

    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def held_out(doc_id: Column) -> Column:
    """Rows whose label is never learnt: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_chars: int = MAX_CHARS
) -> Network:
    """Fit on a bounded sample of the labelled rows that are not held out.

    Only ids and texts of at most ``2 * sample`` documents of at most ``max_chars`` characters reach the
    driver, of rows with one id the one whose text has the least hash; the share of toxic labels is taken
    over all labelled rows.
    """
    known = labels.where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))
    ).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    wanted = chosen.groupBy("doc_id").agg(F.collect_list("toxic").alias("toxic"))
    rows = (
        documents.where(F.length("text") <= max_chars)
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"), F.first("toxic").alias("toxic"))
        .select("doc_id", F.col("one.text").alias("text"), F.explode("toxic").alias("toxic"))
        .collect()
    )
    rows.sort(key=lambda r: (r["doc_id"], r["text"], r["toxic"]))
    total = sum(counts.values())
    share = (counts.get(1, 0) + 0.5) / (total + 2)
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], share)
