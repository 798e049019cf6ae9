"""Bounded-space online packing of token sequences into windows of one length.

Each partition keeps a fixed number of open windows. A document's whole windows leave at once; its rest
goes into the open window that it fills best. When none has room, the fullest is emitted, topped up
first with the head of the rest if it lacks more than ``slack`` tokens, so what is padded stays small.
Windows still open at the end of the partitions are merged, partitions by the group: their pieces are
placed by the same rule, and what is then still open is poured together, cutting at window ends.

Defined cases: a null or empty text has the closing token only; a special token's literal in a text has
that token's id, as is the tokenizer's default; null and repeated ids are packed row by
row; texts are never cut before they are tokenized; no rows give no pieces. Other columns are not carried.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import arrow_rows, text_or_empty, written

WINDOW, OPEN_WINDOWS, SLACK, CLOSING_ID = 2048, 16, 16, 1
#: Partitions whose open windows are merged together; one window of such a group may stay short.
MERGED_PARTITIONS = 32
#: Words of a generation that a worker remembers with their ids.
REMEMBERED = 400_000
DOCS_AT_ONCE, WORDS_AT_ONCE, ROWS_AT_ONCE = 1500, 200, 4000
#: Letters that neither compose with others nor gain a mark in lower case.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
#: Pieces of a text that the tokenizer never joins: it splits at blanks, and letters from what is none.
#: The cut behind letters is in front of ASCII only, as letters beyond may go on or compose.
SEGMENTS = re.compile(rf"[^ \n{LETTERS}]*+[{LETTERS}]++(?=[\x00-\x7f]|\Z)|[^ \n]+")
WIDTH = 4

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
STAGED = f"{PIECES}, open boolean, part long"


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    length: int
    ids: bytes
    doc_tokens: int

    def cut(self, length: int) -> tuple[Piece, Piece]:
        head = self._replace(length=length, ids=self.ids[: length * WIDTH])
        return head, self._replace(
            start=self.start + length, length=self.length - length, ids=self.ids[length * WIDTH :]
        )


class Packer:
    """The open windows of one partition."""

    def __init__(self, window: int, most_open: int, slack: int) -> None:
        self.window, self.most_open, self.slack = window, most_open, slack
        self.open: list[list[Piece]] = []
        self.room: list[int] = []

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; yields the windows that are emitted for it."""
        while piece.length >= self.window:
            head, piece = piece.cut(self.window)
            yield [head]
        while piece.length:
            fitting = [i for i, room in enumerate(self.room) if room >= piece.length]
            if fitting:
                best = min(fitting, key=self.room.__getitem__)
                self.open[best].append(piece)
                self.room[best] -= piece.length
                if not self.room[best]:
                    yield self._take(best)
                return
            if len(self.open) < self.most_open:
                self.open.append([piece])
                self.room.append(self.window - piece.length)
                return
            fullest = min(range(len(self.room)), key=self.room.__getitem__)
            if self.room[fullest] > self.slack:
                head, piece = piece.cut(self.room[fullest])
                self.open[fullest].append(head)
            yield self._take(fullest)

    def _take(self, i: int) -> list[Piece]:
        self.room.pop(i)
        return self.open.pop(i)

    def poured(self) -> Iterator[list[Piece]]:
        """What is open, put together and cut at window ends."""
        left = sorted(self.open, key=lambda w: -sum(p.length for p in w))
        window, room = [], self.window
        for piece in (p for w in left for p in w):
            while piece.length > room:
                if room:
                    head, piece = piece.cut(room)
                    window.append(head)
                yield window
                window, room = [], self.window
            window.append(piece)
            room -= piece.length
        if window:
            yield window
        self.open, self.room = [], []


@cache
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def literals(path: str) -> list[str]:
    """What the tokenizer takes as one token wherever it stands in a text."""
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


@cache
def word_ends(path: str) -> np.ndarray:
    """Which ids end a word."""
    vocabulary = tokenizer(path).get_vocab(with_added_tokens=True)
    ends = np.zeros(max(vocabulary.values()) + 1, bool)
    ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    return ends


def only_letters(word: str) -> bool:
    """Whether a word consists of letters, also as the tokenizer composes and lower-cases it."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


def encoded_words(path: str, words: Iterable[str]) -> Iterator[tuple[str, bytes]]:
    """Every word with its ids.

    Words of ASCII letters go to the tokenizer's model in lower case, as its earlier steps leave them. Other
    words of letters go to the tokenizer many at a time and are told apart by the ids that end a
    word; all others, and lines in which that does not come out even, go one by one.
    """
    encode, model = tokenizer(path).encode_batch_fast, tokenizer(path).model.tokenize
    letters, single = [], []
    for word in words:
        if word.isascii() and word.isalpha():
            yield word, np.array([t.id for t in model(word.lower())], "<u4").tobytes()
        else:
            (letters if only_letters(word) else single).append(word)
    lines = [letters[a : a + WORDS_AT_ONCE] for a in range(0, len(letters), WORDS_AT_ONCE)]
    for line, found in zip(lines, encode([" ".join(x) for x in lines], add_special_tokens=False), strict=True):
        ids = np.asarray(found.ids, "<u4")
        ends = ((np.flatnonzero(word_ends(path)[ids]) + 1) * WIDTH).tolist()
        if len(ends) != len(line):
            single += line
            continue
        blob = ids.tobytes()
        yield from zip(line, map(blob.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True)
    for word, found in zip(single, encode(single, add_special_tokens=False), strict=True):
        yield word, np.asarray(found.ids, "<u4").tobytes()


class WordIds(dict):
    """Ids of words as bytes, in two generations: what is asked for again stays.

    The tokenizer never joins text across the borders of words, so a text has the ids of its words one
    after another. It lower-cases, so words in ASCII that differ in case are tokenized once. A text with
    the literal of a special token is tokenized whole.
    """

    def __init__(self, path: str) -> None:
        self.path, self.older = path, {}
        self.literals = literals(path)

    def of(self, texts: list[str]) -> list[bytes]:
        plain = [not any(x in t for x in self.literals) for t in texts]
        split = [SEGMENTS.findall(t) if p else () for t, p in zip(texts, plain, strict=True)]
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        # Loops over the words of these texts: set operations with a dict of words walk through all of it.
        self._learn([w for w in set().union(*split) if w not in self])
        found = [b"".join(map(self.__getitem__, words)) for words in split]
        for i in [i for i, p in enumerate(plain) if not p]:
            ids = tokenizer(self.path).encode(texts[i], add_special_tokens=False).ids
            found[i] = np.asarray(ids, "<u4").tobytes()
        return found

    def _learn(self, words: list[str]) -> None:
        older = self.older
        self.update({w: older[w] for w in words if w in older})
        forms = {w: w.lower() if w.isascii() else w for w in words if w not in older}
        # No literal may come about by lower-casing.
        lines = "\n".join(forms.values())
        if any(x in lines for x in self.literals):
            forms = {w: w if any(x in form for x in self.literals) else form for w, form in forms.items()}
        new = [form for form in set(forms.values()) if form not in self]
        self.update({form: older[form] for form in new if form in older})
        self.update(encoded_words(self.path, sorted(form for form in new if form not in older)))
        self.update({w: self[form] for w, form in forms.items() if w != form})


@cache
def word_ids(path: str) -> WordIds:
    """One memory per worker, which its tasks share."""
    return WordIds(path)


def _rows(windows: Iterable[tuple[int, list[Piece]]]) -> Iterator[tuple]:
    for number, window in windows:
        offset = 0
        for p in window:
            yield (*p, number, offset)
            offset += p.length


def stage_windows(
    documents: DataFrame, tokenizer_path: str, window: int, most_open: int, slack: int, closing_id: int
) -> DataFrame:
    """Pieces of the emitted and of the still open windows of every partition."""
    closing = np.asarray([closing_id], "<u4").tobytes()
    names = [f.split()[0] for f in STAGED.split(", ")]

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words = TaskContext.get().partitionId(), word_ids(tokenizer_path)
        packer, number, rows = Packer(window, most_open, slack), part << 32, []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 3 + [pa.bool_(), pa.int64()]
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )
            rows.clear()
            return made

        def packed(held: list[tuple]) -> None:
            nonlocal number
            for (doc_id, _), ids in zip(held, words.of([t for _, t in held]), strict=True):
                total = len(ids) // WIDTH + 1
                for full in packer.add(Piece(doc_id, 0, total, ids + closing, total)):
                    rows.extend((*r, False, part) for r in _rows([(number, full)]))
                    number += 1

        held: list[tuple] = []
        for row in arrow_rows(batches, "doc_id", "text"):
            held.append(row)
            if len(held) == DOCS_AT_ONCE:
                packed(held)
                held = []
            if len(rows) >= ROWS_AT_ONCE:
                yield batch()
        packed(held)
        rows.extend((*r, True, part) for r in _rows(enumerate(packer.open, number)))
        if rows:
            yield batch()

    return documents.mapInArrow(pack, STAGED)


def merge_open(left: DataFrame, window: int, most_open: int, slack: int, partitions: int) -> DataFrame:
    """Open windows of neighbouring partitions, filled up with one another.

    A group holds at most ``partitions`` times ``most_open`` windows, whatever the input.
    """
    names = [f.split()[0] for f in PIECES.split(", ")]

    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["sequence_id", "offset"])
        packer, done = Packer(window, most_open, slack), []
        ids = [None if pd.isna(d) else int(d) for d in frame["doc_id"]]
        others = frame[["start", "length", "ids", "doc_tokens"]].itertuples(index=False, name=None)
        for doc_id, (start, length, blob, total) in zip(ids, others, strict=True):
            done.extend(packer.add(Piece(doc_id, int(start), int(length), bytes(blob), int(total))))
        done.extend(packer.poured())
        made = pd.DataFrame(
            _rows(enumerate(done, (1 << 62) + (int(key[0]) << 32))), columns=names
        )
        return made.astype({"doc_id": "Int64"})

    grouped = left.withColumn("group", F.floor(F.col("part") / partitions).cast("long")).groupBy("group")
    return grouped.applyInPandas(merge, PIECES)


def pack(
    documents: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    most_open: int = OPEN_WINDOWS,
    slack: int = SLACK,
    closing_id: int = CLOSING_ID,
    merged_partitions: int = MERGED_PARTITIONS,
) -> DataFrame:
    """Pieces of all ``documents`` (doc_id, text) with their ids (little-endian 32 bit) and place."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    staged = written(
        stage_windows(rows, tokenizer_path, window, most_open, slack, closing_id), "packed"
    )
    done = staged.where("NOT open").drop("open", "part")
    return done.unionByName(
        merge_open(staged.where("open").drop("open"), window, most_open, slack, merged_partitions)
    )
