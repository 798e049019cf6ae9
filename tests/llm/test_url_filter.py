import pytest

from catkeep.llm import url_filter
from catkeep.llm.queries import URL_RULES

URLS = [
    ("http://www.Example.com/en/a?x=1", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://blog.example.com/en/a", "blog.example.com", "/en/a", "example.com/en/", "block"),
    ("https://example.com", "example.com", "", None, "allow"),
    ("https://example.com/", "example.com", "/", "com/", "allow"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("ftp://a.net/es/x#y", "a.net", "/es/x", "net/es/", "block"),
    ("ftp://a.net?es/", "a.net", "", None, "allow"),
    ("no scheme/es/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://", "", "", None, "allow"),
    ("x://bad.org/p/?b=2&utm_source=q&a=1#top", "bad.org", "/p/", None, "block"),
    ("http://bad.org:80/p?a=1&b=2", "bad.org:80", "/p", None, "block"),
    ("http://bad.org/P?a=1&b=2", "bad.org", "/P", None, "allow"),
    ("http://k\u212a.org/" + "y" * 9000, "k\u212a.org", "/" + "y" * 9000, None, "allow"),
]


def judged(spark, urls, listed, **options):
    frame = spark.createDataFrame(
        [(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, verdict string"
    )
    listed = spark.createDataFrame([(c,) for c in listed], "canonical string")
    return url_filter.judge(frame, listed, URL_RULES, **options)


@pytest.mark.parametrize("blocks", [None, 1, 4096])
def test_cases(spark, blocks):
    result = judged(spark, [u[0] for u in URLS], ["bad.org/p?a=1&b=2", "bad.org/p?a=1&b=2", None], blocks=blocks)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in result.collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}


def test_one_crowded_block_lets_false_hits_through_and_the_join_removes_them(spark):
    listed = [f"l.org/{i}" for i in range(3000)]
    urls = [f"http://l.org/{i}" for i in range(2990, 3200)] * 2
    rows = judged(spark, urls, listed, blocks=1).collect()
    assert all(r["listed"] == (int(r["path"][1:]) < 3000) == (r["verdict"] == "block") for r in rows)
    assert len(rows) == 420 and any(r["possible"] and not r["listed"] for r in rows)


def test_sized_filter_passes_few(spark):
    rows = judged(spark, [f"http://m.org/{i}" for i in range(4000)], [f"l.org/{i}" for i in range(1000)]).collect()
    assert sum(r["possible"] for r in rows) < 100
    assert not any(r["listed"] for r in rows)


def test_empty_tables(spark):
    assert judged(spark, [], []).count() == 0
    assert [r["verdict"] for r in judged(spark, ["http://a.org/"], []).collect()] == ["allow"]


def test_native_plan(spark):
    plan = judged(spark, ["http://a.org/"], ["a.org"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan
