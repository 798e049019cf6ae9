import math
import re
from collections import Counter

import pytest

from catkeep.llm import term_search
from tests.llm.helpers import documents, no_documents, odd_documents

TERM = re.compile(term_search.TERM)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, k):
    counted = [(r["doc_id"], Counter(TERM.findall(lowered(r["text"])))) for r in docs]
    n_docs, total = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for r in items:
        asked.setdefault(r["item_id"], set()).update(TERM.findall(lowered(r["text"])))
    found = []
    for item, terms in asked.items():
        scores = []
        for doc_id, c in counted:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in terms & set(c)
            )
            if score > 0:
                scores.append((-score, (doc_id is not None, doc_id or 0), doc_id))
        ranked = sorted(scores, key=lambda s: s[:2])[:k]
        found += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(ranked)]
    return Counter(found)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, score string")


ITEMS = [
    (1, "word AND more two", "x", "y"), (2, None, None, None), (3, "", "", ""), (4, "nowhere-found zzz", "", ""),
    (5, "same text twice", "", ""), (5, "controls over", "", ""), (None, "éàü 漢字 x", "", ""), (7, "a b c d e one it", "", ""),
    (7, "a b c d e one it", "", ""),
]


@pytest.mark.parametrize("options", [{}, {"shard_docs": 3, "block_items": 2}, {"stages": (1500, 900, 300), "shard_docs": 1}])
def test_odd_rows(spark, options):
    docs = odd_documents(spark, term="clash", shard="clash").repartition(3)
    items = items_of(spark, ITEMS)
    for k in (2, 50):
        got = Counter(tuple(r) for r in term_search.search(docs, items, k=k, **options).collect())
        assert got == brute(docs.collect(), items.collect(), k)


def test_ties_go_by_document(spark):
    docs = documents(spark, ["same words here", "other text", *["same words here"] * 40]).repartition(5)
    items = items_of(spark, [(1, "same here", "", "")])
    got = [tuple(r) for r in term_search.search(docs, items, k=10, shard_docs=4).orderBy("rank").collect()]
    assert [d for _, _, d, _ in got] == [0, *range(2, 11)]
    assert Counter(got) == brute(docs.collect(), items.collect(), 10)


def test_no_rows(spark):
    none = items_of(spark, [])
    some = items_of(spark, ITEMS)
    assert term_search.search(no_documents(spark), some).count() == 0
    assert term_search.search(odd_documents(spark), none).count() == 0


def test_a_term_that_shares_a_bit_is_not_counted(spark, monkeypatch):
    monkeypatch.setattr(term_search, "MAP_BITS", 64)
    docs, items = odd_documents(spark), items_of(spark, ITEMS)
    got = Counter(tuple(r) for r in term_search.search(docs, items).collect())
    assert got == brute(docs.collect(), items.collect(), 50)
