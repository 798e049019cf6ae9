"""SentencePiece BPE: each prefix of a text has one last token, and those give the ids from the end.

BPE has two properties that replace its merging loop. The tokens of a prefix of the text, up to any
token's end, are the BPE of that prefix; and a row of tokens is the BPE of its text exactly if each two
neighbours are the BPE of theirs. So the last token of a prefix is the one piece that ends there (an
automaton finds all of them in one pass) and that is compatible with the last token before it. A
table of last tokens per prefix is filled left to right and read from the end backwards. Compatibility of a
pair is decided once, by replaying how the two pieces come about side by side, and remembered.

Texts are encoded where they lie, without a shuffle. A text is cut wherever no piece can lie across, as in
front of spaces; the words are encoded apart, each once per worker as long as it is remembered.

Decoding looks ids up in the table of pieces. Bytes that make no character become U+FFFD one by one, a
space at the very beginning is the one that encoding put there, and control ids have no text.

Defined cases: a null or empty text has no ids and decodes to an empty text; null and repeated ids of
documents are kept row by row; texts are never cut; no rows give no rows; null ids or ids beyond the
vocabulary are an error in decoding. Other columns are carried, those named like the result are replaced.
Only BPE models with byte pieces and without unused or user-defined pieces are read.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catkeep.llm.common import keep_but

SPACE = "▁"
#: Words of a generation and pairs that a worker remembers; the pairs are started anew beyond that.
WORDS_REMEMBERED, PAIRS_REMEMBERED = 200_000, 1_000_000
#: Longer words are encoded each time they come.
LONGEST_REMEMBERED = 64
#: Rows whose ids go back to Spark together.
ROWS_AT_ONCE = 500
#: Score of what is no piece.
NEVER = float("-inf")


class History(NamedTuple):
    """How a piece comes about: the score of each merge, and the outer parts before and after each."""

    scores: list[float]
    first: list[str]
    last: list[str]


def history(piece: str, score: dict[str, float]) -> History | None:
    """The merging loop on one piece: the best scored neighbours, of equal ones the first, become one.

    None if the piece does not come about that way.
    """
    parts, made = list(piece), History([], [piece[0]], [piece[-1]])
    while len(parts) > 1:
        best, at = NEVER, 0
        for i in range(len(parts) - 1):
            found = score.get(parts[i] + parts[i + 1], NEVER)
            if found > best:
                best, at = found, i
        if best == NEVER:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        made.scores.append(best)
        made.first.append(parts[0])
        made.last.append(parts[-1])
    made.scores.append(NEVER)
    return made


def crosses(left: History, right: History, score: dict[str, float]) -> bool:
    """Whether a merge over the border comes before the two pieces are whole, or after.

    Both histories go on side by side, the better merge first, of equal ones the left; the border's own
    merge stands between the two.
    """
    i = j = 0
    while True:
        over = score.get(left.last[i] + right.first[j])
        if over is not None and over > left.scores[i] and over >= right.scores[j]:
            return True
        if left.scores[i] < right.scores[j]:
            j += 1
        elif left.scores[i] == NEVER:
            return False
        else:
            i += 1


#: Letters that words mostly consist of.
LETTERS = r"A-Za-z\u00c0-\u024f"


def word_pattern(pieces: Iterable[str]) -> re.Pattern:
    """Cuts a text where no piece lies across, so that nothing is merged over a cut.

    That is in front of spaces, around ASCII characters that no longer piece holds, and between a letter
    and ASCII punctuation that no piece holds behind a letter. If a piece has a space behind another
    character, a text is one word.
    """
    longer = [p for p in pieces if len(p) > 1]
    if any(SPACE in p.lstrip(SPACE) for p in longer):
        return re.compile("(?s).+")
    held = set("".join(longer))
    behind = {b for p in longer for _, b in re.findall(f"(?=([{LETTERS}])(.))", p, re.DOTALL)}
    marks = {chr(c) for c in range(128) if not chr(c).isalnum()}
    lone, after = (
        "".join(f"\\x{ord(c):02x}" for c in sorted(chars)) for chars in (marks - held | {" "}, marks - behind | {" "})
    )
    return re.compile(
        f"{SPACE}*[{LETTERS}]+(?=[{SPACE}{after}]|$)|[{lone}]|{SPACE}*[^{SPACE}{lone}]+|{SPACE}+"
    )


class _Words(dict):
    """Ids of the words asked for lately, in two generations: what is asked for again stays."""

    def __init__(self, encode_word: Callable[[str], bytes]) -> None:
        self.encode_word = encode_word
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.encode_word(word)
        if len(word) <= LONGEST_REMEMBERED:
            if len(self) >= WORDS_REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Pieces:
    """A model's pieces, their automaton and which of them may stand side by side."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        if any(map(model.is_unused, range(size))):
            raise ValueError("unused pieces are not supported")
        self.normalize = model.normalize
        self.bytes = [0] * 256
        self.score: dict[str, float] = {}
        self.names: list[str] = []
        self.ids: list[int | None] = []
        #: UTF-8 text of each id.
        self.surface: list[bytes] = []
        self.is_byte, self.leading, self.silent = (np.zeros(size, bool) for _ in range(3))
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(name[3:5], 16)
                self.bytes[value], self.is_byte[i] = i, True
                self.surface.append(bytes([value]))
            elif model.is_control(i):
                self.silent[i] = True
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.score[name] = model.get_score(i)
                self.names.append(name)
                self.ids.append(i)
                self.leading[i] = name.startswith(SPACE)
                self.surface.append(name.replace(SPACE, " ").encode())
        if not self.is_byte.sum() == 256:
            raise ValueError("the model has no byte pieces")
        # Characters of pieces that are no piece themselves are joined like others.
        for char in sorted(set("".join(self.names)) - set(self.names)):
            self.names.append(char)
            self.ids.append(None)
        self.sizes = list(map(len, self.names))
        self.automaton = ahocorasick.Automaton()
        for number, name in enumerate(self.names):
            self.automaton.add_word(name, (len(name), number))
        self.automaton.make_automaton()
        self.words = word_pattern(self.names).findall
        self.pairs: dict[int, bool] = {}
        self.histories: dict[int, History | None] = {}
        self.known = _Words(self.encode_word)

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two pieces are the BPE of their text (left -1: at the start of a text)."""
        if len(self.pairs) >= PAIRS_REMEMBERED:
            self.pairs.clear()
        made = self._history(right)
        fits = made is not None and (left < 0 or not crosses(self._history(left), made, self.score))
        self.pairs[left * len(self.names) + right] = fits
        return fits

    def _history(self, token: int) -> History | None:
        if token not in self.histories:
            self.histories[token] = history(self.names[token], self.score)
        return self.histories[token]

    def last_tokens(self, word: str) -> list[int]:
        """The last token of every prefix; -1 for the empty one and behind a character of no piece."""
        last, many, known = [-1] * (len(word) + 1), len(self.names), self.pairs.get
        for end, (size, token) in self.automaton.iter(word):
            if last[end + 1] < 0:
                left = last[end + 1 - size]
                fits = known(left * many + token)
                if self.compatible(left, token) if fits is None else fits:
                    last[end + 1] = token
        return last

    def encode_word(self, word: str) -> bytes:
        """Ids of a word as 32-bit numbers."""
        last, end, ids = self.last_tokens(word), len(word), array("i")
        while end:
            token = last[end]
            known = None if token < 0 else self.ids[token]
            if known is None:
                ids.extend(self.bytes[b] for b in reversed(word[end - 1].encode("utf-8")))
            else:
                ids.append(known)
            end -= 1 if token < 0 else self.sizes[token]
        ids.reverse()
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        words = self.words(self.normalize(text)) if text else ()
        return np.frombuffer(b"".join(map(self.known.__getitem__, words)), np.int32)

    def text_of(self, ids: np.ndarray, joined: bytes) -> str:
        """The text of ids, given what their surfaces make one after another."""
        shown = ids[: np.argmin(self.silent[ids]) + 1] if len(ids) else ids
        skip = int(len(shown) > 0 and self.leading[shown[-1]])
        try:
            # Bytes on both sides of a control id make no character together.
            if not self.silent[ids].any():
                return joined[skip:].decode("utf-8")
        except UnicodeDecodeError:
            pass
        return self._mended(ids)[skip:]

    def _mended(self, ids: np.ndarray) -> str:
        """Runs of byte pieces are read as UTF-8 on their own."""
        parts, at = [], 0
        cuts = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        for end in [*cuts.tolist(), len(ids)]:
            blob = b"".join(self.surface[i] for i in ids[at:end].tolist())
            parts.append(lone_bytes_replaced(blob) if self.is_byte[ids[at]] else blob.decode("utf-8"))
            at = end
        return "".join(parts)


def lone_bytes_replaced(blob: bytes) -> str:
    """UTF-8 in which each byte that starts no whole character becomes U+FFFD."""
    made, at = [], 0
    while at < len(blob):
        for size in (1, 2, 3, 4):
            try:
                made.append(blob[at : at + size].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            made.append("�")
            size = 1
        at += size
    return "".join(made)


@cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode(docs: DataFrame, model_path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of the text (array<int>) in place of the text."""
    others = keep_but(docs, (into, text))
    rows = docs.select(*others, F.col(f"`{text}`").cast("string"))
    carried = rows.columns[:-1]
    schema = rows.select(*others).withColumn(into, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = pieces_of(model_path).encode
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                found = list(map(one, batch.column(batch.num_columns - 1).to_pylist()))
                edges = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = pa.array(np.concatenate(found), pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(edges), flat)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*carried, into])

    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for."""
    rows = encoded.select(*keep_but(encoded, (into,)))
    carried, at = rows.columns, rows.columns.index(ids)
    schema = rows.withColumn(into, F.lit(None).cast("string")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model_path)
        table = pa.array(pieces.surface, pa.large_binary())
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(first, ROWS_AT_ONCE)
                lists = batch.column(at)
                numbers = lists.flatten()
                if lists.null_count or numbers.null_count:
                    raise ValueError("ids are null")
                offsets = pc.subtract(lists.offsets, lists.offsets[0]).cast(pa.int64())
                taken = pa.LargeListArray.from_arrays(offsets, pc.take(table, numbers))
                joined = pc.binary_join(taken, pa.scalar(b"", pa.large_binary())).to_pylist()
                numbers, edges = numbers.to_numpy(), offsets.to_numpy()
                texts = [
                    pieces.text_of(numbers[a:b], blob)
                    for a, b, blob in zip(edges[:-1], edges[1:], joined, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.string())], [*carried, into]
                )

    return rows.mapInArrow(run, schema)
