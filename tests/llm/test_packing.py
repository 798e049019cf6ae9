import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from catkeep.llm import packing
from catkeep.llm.queries import op4_packing
from tests.llm.helpers import characters, documents, no_documents, odd_documents, table

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def whole_ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [1]


def check(pieces, texts, window):
    """Every id in exactly one piece, windows gapless and not too long; returns the padded share."""
    docs, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == 4 * p["length"] > 0
        docs[p["doc_id"]].append(p)
        windows[p["sequence_id"]].append(p)
    assert docs.keys() == texts.keys()
    for doc_id, parts in docs.items():
        parts.sort(key=lambda p: p["start"])
        ids = np.concatenate([np.frombuffer(bytes(p["ids"]), "<u4") for p in parts]).tolist()
        assert ids == whole_ids(texts[doc_id])
        at = 0
        for p in parts:
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
    used = 0
    for parts in windows.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        used += at
    return 1 - used / (window * max(1, len(windows)))


def test_whole_table(spark, sf_dir):
    frame = table(spark, sf_dir, "documents").repartition(6)
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    assert check(packing.pack(frame, PATH).collect(), texts, 2048) < 0.02


def test_query_digest(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    for p in op4_packing(spark, sf_dir).collect():
        ids = whole_ids(texts[p["doc_id"]])[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.asarray(ids, "<u4").tobytes())


def test_odd_texts(spark):
    frame = odd_documents(spark, ids="clash", length=7).where("doc_id IS NULL OR doc_id <> 3").repartition(4)
    texts = {r["doc_id"]: r["text"] for r in frame.collect()}
    check(packing.pack(frame, PATH, window=64, most_open=2, slack=3, merged_partitions=2).collect(), texts, 64)


def test_literals_of_special_tokens():
    texts = [
        "hello <|endoftext|> world", "hello <|ENDOFTEXT|> world", "Ab<|endoftext|>,Cd <|startoftext|>", "<|EndOfText|><|endoftext|>.",
        "<|endoftext|>'LL x<|endoftext|\u212a> <|endoftext| > <|endo\nftext|>",
    ]
    for text, ids in zip(texts, packing.WordIds(PATH).of(texts), strict=True):
        assert [*np.frombuffer(ids, "<u4").tolist(), 1] == whole_ids(text)
    assert whole_ids(texts[0]) == [3306, 49407, 1002, 1]


def test_repeated_rows_and_none(spark):
    frame = documents(spark, ["a b c"]).unionByName(documents(spark, ["a b c"]))
    assert [p["length"] for p in packing.pack(frame, PATH).collect()] == [4, 4]
    assert packing.pack(no_documents(spark), PATH).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=60), st.integers(1, 4), st.integers(0, 5))
def test_packer_keeps_every_token_and_its_bounds(sizes, most_open, slack):
    packer, windows = packing.Packer(32, most_open, slack), []
    for i, n in enumerate(sizes):
        ids = np.full(n, i, "<u4").tobytes()
        for window in packer.add(packing.Piece(i, 0, n, ids, n)):
            assert sum(p.length for p in window) >= 32 - slack
            windows.append(window)
        assert len(packer.open) <= most_open
    windows += packer.poured()
    assert all(sum(p.length for p in w) <= 32 for w in windows)
    assert sum(p.length for w in windows for p in w) == sum(sizes)


def test_every_character_has_the_librarys_ids():
    """At the end of a word and in front of punctuation, between letters, and alone."""
    words = packing.WordIds(PATH)
    plain = Tokenizer.from_file(PATH)
    codes = characters()
    for first in range(0, len(codes), 8192):
        texts = [f"AB{chr(c)}. x{chr(c)}y, {chr(c)}! ({chr(c)}e\n{chr(c)}'s Q{chr(c)}" for c in codes[first : first + 8192]]
        wanted = plain.encode_batch(texts, add_special_tokens=False)
        for text, ids, want in zip(texts, words.of(texts), wanted, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == want.ids, ascii(text)


def test_a_memory_that_runs_full(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    for _ in range(3):
        for text in ("The the THE cat, a (cat)", "other words don't come", "cat <|ENDOFTEXT|> <|endoftext|>x the"):
            [ids] = words.of([text])
            assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_new_words_do_not_walk_through_the_memory():
    class Unwalked(dict):
        def __iter__(self):
            raise AssertionError("all remembered words were walked through")

    words = packing.WordIds(PATH)
    words.of(["some words that are known"])
    words.older = Unwalked(words)
    words.clear()
    [ids] = words.of(["Some words, and others THAT are new"])
    assert [*np.frombuffer(ids, "<u4").tolist(), 1] == whole_ids("Some words, and others THAT are new")


def test_words_of_ascii_letters_have_the_librarys_ids():
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyzEARSTI"))
    made = {"".join(rng.choice(letters, n)) for n in rng.integers(1, 30, 3000)} | {"x" * 5000, "S", "ll", "RE"}
    for word, ids in packing.encoded_words(PATH, sorted(made)):
        assert [*np.frombuffer(ids, "<u4").tolist(), 1] == whole_ids(word)
        made.remove(word)
    assert not made
