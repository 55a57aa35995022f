"""Aliases that differ in the case of the host or in a fragment, and pages with several tags."""

from sparkloom.llm import url_filters as op


def test_aliases(spark):
    """Before, only the first tag counted, and urls met only if they were the same text."""
    pages = [
        (0, "http://a.org/x", '<link rel="canonical" href="HTTP://B.Example.COM/p#top">'),
        (1, "http://b.example.com/p", None),
        (2, "http://c.org/y#part", ""),
        (3, "http://d.org/z", '<link rel="canonical" href="http://d.org/z"><link rel="canonical" href="http://bad.test/1">'),
        (4, "http://e.org/q", '<meta http-equiv="refresh" content="0; url=/r"><meta http-equiv=refresh content="0;url=http://C.org/y">'),
        (5, "http://bad.test/1#frag", '<a href="http://f.org/">'),
        (6, "no scheme#here", ""),
        (7, None, '<link rel="canonical" href="http://bad.test/1">'),
    ]
    rules = op.rules_table(spark, [("block", "b.example.com", "/"), ("block", "c.org", "/y"), ("block", "bad.test", "/")])
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in op.judge_urls(frame, rules, keep=["page_id"]).collect()}
    assert got == {0: "block", 1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow"}
