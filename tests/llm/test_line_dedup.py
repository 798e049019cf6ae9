from catkeep.llm import line_dedup
from tests.llm.helpers import documents, no_documents, odd_documents


def brute(rows, min_sites):
    sites = {}
    for r in rows:
        for line in (r["text"] or "").split("\n"):
            if line.strip(" "):
                sites.setdefault(line.strip(" "), set()).add(r["source"])
    spread = {k for k, v in sites.items() if len(v - {None}) >= min_sites}
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        kept = [x for x in lines if x.strip(" ") not in spread]
        out.append((r["doc_id"], "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def check(frame, **options):
    found = line_dedup.remove_spread_lines(frame, **options).collect()
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found), key=str)
    assert got == brute(frame.collect(), options["min_sites"])
    return found


def test_threshold_is_exact_on_either_side(spark):
    texts = [f"on {n}\nown {i}\n\n ends " for n in range(1, 60) for i in range(n)]
    frame = documents(spark, texts).selectExpr("doc_id", "text", "lang", "n_chars", "concat('s', substr(split(text, '\n')[1], 5)) AS source")
    for sites in (3, 20, 40):
        check(frame, min_sites=sites, lg_k=4)


def test_sketch_decides_clear_lines_and_counts_the_near(spark):
    rows = documents(spark, [f"far\nnear {i % 3}" for i in range(400)]).selectExpr("doc_id", "text", "cast(doc_id as string) source")
    check(rows, min_sites=133, lg_k=8)


def test_odd_rows(spark):
    found = check(odd_documents(spark, n_removed="clash"), min_sites=2)
    assert {"lang", "n_chars"} <= set(found[0].asDict())
    assert line_dedup.remove_spread_lines(no_documents(spark)).count() == 0
