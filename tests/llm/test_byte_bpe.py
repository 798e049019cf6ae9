import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from catkeep.llm import byte_bpe
from tests.llm.helpers import characters, documents, no_documents, odd_documents, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WHOLE = tiktoken.Encoding(
    "whole", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
)


def roundtrip(frame, **options):
    return byte_bpe.decode(byte_bpe.encode(frame, RANKS, PATTERN, **options), RANKS)


def check(frame, rows):
    got = sorted(((r["doc_id"], list(r["ids"]), bytes(r["decoded"])) for r in rows), key=str)
    want = [
        (r["doc_id"], WHOLE.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in frame.collect()
    ]
    assert got == sorted(want, key=str)


def test_whole_table(spark, sf_dir):
    frame = table(spark, sf_dir, "documents")
    check(frame, roundtrip(frame).collect())


def test_odd_texts_in_small_blocks(spark):
    frame = odd_documents(spark, ids="clash", decoded="clash").repartition(3)
    check(frame, roundtrip(frame, block_chars=40, buckets=5).collect())


def test_no_rows(spark):
    assert roundtrip(no_documents(spark)).count() == 0


def test_each_word_goes_once_per_block(spark):
    frame = documents(spark, ["the the the cat"] * 50).coalesce(1)
    [row] = byte_bpe.blocks_of(frame.select("doc_id", "text"), PATTERN, 4, 10**6).collect()
    words = [w for part in row["parts"] for w in byte_bpe.words_in(part["sizes"], part["words"])]
    assert sorted(words) == [b" cat", b" the", b"the"]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_split_agrees_with_the_library(text):
    pieces = byte_bpe.splitter(PATTERN)(text)
    assert "".join(pieces) == text
    ids = [i for p in pieces for i in WHOLE._core_bpe.encode_single_piece(p.encode())]
    assert ids == WHOLE.encode_ordinary(text)


def test_every_character_is_split_as_by_the_library():
    find = byte_bpe.splitter(PATTERN)
    one = WHOLE._core_bpe.encode_single_piece
    codes = characters()
    for first in range(0, len(codes), 2048):
        text = "".join(f"{chr(c)}'s a{chr(c)}1{chr(c)} {chr(c)}.{chr(c)}\n{chr(c)} {chr(c)}" for c in codes[first : first + 2048])
        pieces = find(text)
        assert "".join(pieces) == text
        assert [i for p in pieces for i in one(p.encode())] == WHOLE.encode_ordinary(text), hex(codes[first])
