"""Maximal periodic stretches of words ("runs"), found from minimizers at several scales.

A run is a stretch of words with smallest period q that is at least ``least`` words and two periods
long and that neither neighbouring word extends. Texts are handled where they lie, without a shuffle; a
task numbers the words of a slice of texts and works on one array, with a word of its own between texts.

* Periods under 16: every lag is scanned directly.
* Longer ones, by scale (periods from Q up to 2Q): each stretch of Q/4 words has a name, equal for equal
  stretches. The least name in each window of Q/2 places is a minimizer. A run is at least two periods
  long, so the window at its start comes again one period on, and with it its minimizer: equal
  minimizers at a distance of Q up to 2Q are the seeds. Minimizers that follow each other within half a
  stretch belong to a run of a shorter period; they count as one arithmetic progression, and two of
  those give one seed for every distance between them.
* Every seed is extended both ways by comparing names of falling length, so an extension takes as many
  steps as there are scales, however long the run is.

Defined cases: a null or empty text has no words, no runs and an empty ``collapsed``; null and repeated ids
are kept row by row; texts are never cut (memory follows the longest text of a task); no rows give
no rows. Input columns named like a result are replaced, all others but the text are carried.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import keep_but

RUNS_TYPE = "array<struct<start: long, length: long, period: long>>"
#: Least number of words in a run.
LEAST = 12
#: Lags below this are scanned; it is the period at which the first scale starts.
FIRST_SCALE = 16
#: Words handled together; a longer text is alone.
SLICE_WORDS = 400_000


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last of each stretch of consecutive numbers in a sorted array."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]] + 1


def _counted(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. counts[i] - 1 for every i, one after another."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def name_levels(words: np.ndarray) -> list[np.ndarray]:
    """Level k has at each place a name for the 2**k words from there on.

    Names are equal where the words are; a stretch that occurs once has a negative name of its own. The
    last level is the last at which any stretch occurs twice.
    """
    n, size = len(words), 1
    places, keys = np.arange(n), words.astype(np.int64)
    levels = []
    while len(places):
        _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = counts[inverse] > 1
        if not twice.any():
            break
        names = -1 - np.arange(n, dtype=np.int32)
        names[places[twice]] = inverse[twice]
        levels.append(names)
        places = places[twice]
        places = places[places + size < n]
        places = places[names[places + size] >= 0]
        keys = names[places].astype(np.int64) * n + names[places + size]
        size *= 2
    return levels


def extension(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
    """How many words from places a and b on (back: up to and without them) are alike; a < b."""
    n = len(levels[0]) if levels else 0
    done = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        size, names = 1 << k, levels[k]
        at, to = (a - done - size, b - done - size) if back else (a + done, b + done)
        inside = np.flatnonzero((at >= 0) & (to + size <= n))
        same = inside[names[at[inside]] == names[to[inside]]]
        done[same] += size
    return done


def lag_runs(words: np.ndarray, lags: Iterable[int], least: int) -> Iterator[tuple]:
    """Starts, ends and period of what each lag repeats for long enough."""
    for lag in lags:
        starts, ends = _stretches(np.flatnonzero(words[lag:] == words[:-lag]))
        long = ends - starts >= max(least - lag, lag)
        yield starts[long], ends[long] + lag, np.full(int(long.sum()), lag)


def minimizers(names: np.ndarray, window: int) -> np.ndarray:
    """Places of the least hashed name in windows of places whose stretches all occur twice."""
    starts, ends = _stretches(np.flatnonzero(names >= 0))
    long = ends - starts >= window
    sizes = (ends - starts)[long]
    places = np.repeat(starts[long], sizes) + _counted(sizes)
    if len(places) < window:
        return np.empty(0, np.int64)
    hashed = (names[places].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    # The place in the low half makes the first of equal names the least.
    least = (hashed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(places), dtype=np.uint64)
    step = 1
    while step < window:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    return places[np.unique(least & np.uint64(0xFFFFFFFF)).astype(np.int64)]


def seeds(names: np.ndarray, first_period: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and distances of equal minimizers that are one period of this scale apart."""
    stretch = first_period // 4
    picked = minimizers(names, first_period // 2)
    if not len(picked):
        return
    picked = picked[np.lexsort((picked, names[picked]))]
    gaps, alike = np.diff(picked), np.diff(names[picked]) == 0
    heads = np.r_[0, np.flatnonzero(~(alike & (gaps <= stretch // 2))) + 1]
    tails = np.r_[heads[1:], len(picked)] - 1
    first, last, name = picked[heads], picked[tails], names[picked[heads]]
    step = np.gcd.reduceat(np.r_[0, np.where(alike & (gaps <= stretch // 2), gaps, 0)], heads)
    for ahead in range(1, len(heads)):
        a = np.arange(len(heads) - ahead)
        a = a[(name[a] == name[a + ahead]) & (first[a + ahead] - last[a] < 2 * first_period)]
        if not len(a):
            return
        b = a + ahead
        stride = np.maximum(np.gcd(step[a], step[b]), 1)
        low, high = first[b] - last[a], last[b] - first[a]
        low += np.maximum(-(-(first_period - low) // stride), 0) * stride
        count = np.maximum((np.minimum(high, 2 * first_period - 1) - low) // stride + 1, 0)
        distance = np.repeat(low, count) + _counted(count) * np.repeat(stride, count)
        yield np.maximum(np.repeat(first[a], count), np.repeat(first[b], count) - distance), distance


def find_runs(words: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and periods of all runs in an array of word numbers, by start and period."""
    found = list(lag_runs(words, range(1, min(FIRST_SCALE, len(words))), least))
    levels = name_levels(words)
    period = FIRST_SCALE
    for names in levels[(FIRST_SCALE // 4).bit_length() - 1 :]:
        for at, distance in seeds(names, period):
            ahead = extension(levels, at, at + distance)
            behind = extension(levels, at, at + distance, back=True)
            long = ahead + behind >= np.maximum(distance, least - distance)
            found.append(((at - behind)[long], (at + distance + ahead)[long], distance[long]))
        period *= 2
    if not found:
        return (np.empty(0, np.int64),) * 3
    starts, ends, periods = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((periods, ends, starts))
    starts, ends, periods = starts[order], ends[order], periods[order]
    # Multiples of a period repeat the same stretch; the smallest is the run's.
    new = np.r_[True, (np.diff(starts) != 0) | (np.diff(ends) != 0)][: len(starts)]
    starts, ends, periods = starts[new], ends[new], periods[new]
    order = np.lexsort((periods, starts))
    return starts[order], ends[order], periods[order]


def _slices(texts: list[bytes | None], most_words: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Where a slice of texts starts, and the words of each of its texts."""
    at, held, size = 0, [], 0
    for i, text in enumerate(texts):
        words = (text or b"").split()
        if held and size + len(words) > most_words:
            yield at, held
            at, held, size = i, [], 0
        held.append(words)
        size += len(words)
    if held:
        yield at, held


def _solve(texts: list[list[bytes]], least: int) -> tuple[pa.Array, pa.Array]:
    """Runs and collapsed text of each list of words."""
    number = _Numbers()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    firsts = np.cumsum(sizes + 1) - sizes - 1
    words = np.empty(int(sizes.sum()) + len(texts), np.int64)
    for first, text in zip(firsts.tolist(), texts, strict=True):
        words[first : first + len(text)] = np.fromiter(map(number.__getitem__, text), np.int64, len(text))
    # Words of different texts differ, and so do the separators behind the texts.
    vocabulary = len(number) + 1
    words += np.repeat(np.arange(len(texts)) * vocabulary, sizes + 1)
    words[firsts + sizes] = np.arange(len(texts)) * vocabulary + vocabulary - 1
    starts, ends, periods = find_runs(words, least)

    of = np.searchsorted(firsts, starts, "right") - 1
    edges = np.searchsorted(of, np.arange(len(texts) + 1)).astype(np.int32)
    fields = [starts - firsts[of], ends - starts, periods]
    structs = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts + periods, 1)
    np.add.at(change, ends, -1)
    kept = np.cumsum(change[:-1]) == 0
    collapsed = []
    for i, (first, text) in enumerate(zip(firsts.tolist(), texts, strict=True)):
        if edges[i] < edges[i + 1]:
            text = compress(text, kept[first : first + len(text)].tolist())
        collapsed.append(b" ".join(text).decode("utf-8"))
    return pa.ListArray.from_arrays(edges, structs), pa.array(collapsed, pa.string())


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = LEAST, slice_words: int = SLICE_WORDS
) -> DataFrame:
    """``docs`` with ``runs`` and ``collapsed`` in place of the text.

    ``runs`` are by start and period, counted in words from 0. ``collapsed`` has the words joined by one
    space, without those that any run contains after its first period.
    """
    others = keep_but(docs, ("runs", "collapsed", text))
    rows = docs.select(*others, F.col(f"`{text}`").cast("string").cast("binary"))
    carried = rows.columns[:-1]
    schema = rows.select(*others).withColumns(
        {"runs": F.lit(None).cast(RUNS_TYPE), "collapsed": F.lit(None).cast("string")}
    ).schema

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for at, words in _slices(texts, slice_words):
                part = batch.slice(at, len(words))
                runs, collapsed = _solve(words, least)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], runs, collapsed], [*carried, "runs", "collapsed"]
                )

    return rows.mapInArrow(solve, schema)
