import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catkeep.llm import sentence_pieces
from tests.llm.helpers import characters, no_documents, odd_documents, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = sentence_pieces.pieces_of(MODEL)


def decoded(ids):
    import numpy as np

    numbers = np.array(ids, np.int64)
    return PIECES.text_of(numbers, b"".join(PIECES.surface[i] for i in ids))


def roundtrip(frame):
    return sentence_pieces.decode(sentence_pieces.encode(frame, MODEL), MODEL)


def check(frame, rows):
    got = sorted(((r["doc_id"], list(r["ids"]), r["decoded"]) for r in rows), key=str)
    want = []
    for r in frame.collect():
        ids = LIBRARY.encode(r["text"] or "")
        want.append((r["doc_id"], ids, LIBRARY.decode(ids)))
    assert got == sorted(want, key=str)


def test_whole_table(spark, sf_dir):
    frame = table(spark, sf_dir, "documents")
    check(frame, roundtrip(frame).collect())


def test_odd_texts_and_clashing_columns(spark):
    frame = odd_documents(spark, ids="clash", decoded="clash", last="kept").repartition(3)
    rows = roundtrip(frame).collect()
    check(frame, rows)
    assert set(rows[0].asDict()) == {"doc_id", "lang", "source", "n_chars", "last", "ids", "decoded"}


def test_no_rows(spark):
    assert roundtrip(no_documents(spark)).count() == 0


def test_null_ids_are_an_error(spark):
    frame = no_documents(spark).select(F.lit(None).cast("array<int>").alias("ids"))
    rows = spark.range(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert sentence_pieces.decode(frame, MODEL).count() == 0
    with pytest.raises(PySparkException):
        sentence_pieces.decode(rows, MODEL).collect()


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("ab the▁ \n\t12-=é漢🙂", max_size=60)))
def test_ids_of_any_text(text):
    ids = PIECES.encode(text).tolist()
    assert ids == LIBRARY.encode(text)
    assert decoded(ids) == LIBRARY.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 31_999), st.integers(0, 270)), max_size=12))
def test_text_of_any_ids(ids):
    assert decoded(ids) == LIBRARY.decode(ids)


def test_every_character():
    """In front of, behind and between letters, and beside a mark and a space."""
    codes = characters()
    for first in range(0, len(codes), 4096):
        text = "".join(f"a{chr(c)}b{chr(c)}. {chr(c)}{chr(c)}x" for c in codes[first : first + 4096])
        assert PIECES.encode(text).tolist() == LIBRARY.encode(text), hex(codes[first])


def test_long_words():
    for text in (" " * 5001, "a" * 20_000, "漢" * 3000, "ab" * 10_000 + "\n" * 3000):
        assert PIECES.encode(text).tolist() == LIBRARY.encode(text)


def test_memories_that_run_full(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "WORDS_REMEMBERED", 3)
    monkeypatch.setattr(sentence_pieces, "PAIRS_REMEMBERED", 5)
    small = sentence_pieces.Pieces(MODEL)
    text = "several different words, several different tokens, over and over again " * 3
    assert small.encode(text).tolist() == LIBRARY.encode(text)
