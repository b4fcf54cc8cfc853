"""URL rules and aliases."""

from __future__ import annotations

from partwise.llm import urls
from partwise.llm.queries import URL_RULES


def canonical(target):
    return f'<html><head><LINK href="{target}" rel=\'canonical\'></head></html>'


def judged(spark, rows, redirects=None):
    pages = spark.createDataFrame([(*row, "x") for row in rows], "page_id long, url string, html string, verdict string")
    if redirects is not None:
        redirects = spark.createDataFrame(redirects, "source string, target string")
    return {r.page_id: r for r in urls.judge(pages, URL_RULES, redirects).collect()}


def test_rules(spark):
    cases = [
        ("http://Example.COM/en/1?x", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/2", "www.example.com", "/en/2", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("http://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
        ("http://example.com/EN/", "example.com", "/EN/", "com/", "allow"),
        ("http://x.net/es/5#f", "x.net", "/es/5", "net/es/", "block"),
        ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
        ("http://x.net/en/", "x.net", "/en/", None, "allow"),
        ("http://x.com", "x.com", "", None, "allow"),
        ("http://x.com?/a://b/", "x.com", "", None, "allow"),
        ("://h/p", "h", "/p", None, "allow"),
        ("http:/x.com/en/", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://É.Com/ü?", "É.com", "/ü", "com/", "allow"),
        ("x.com/://y.net/es/", "y.net", "/es/", "net/es/", "block"),
    ]
    found = judged(spark, [(i, case[0], None) for i, case in enumerate(cases)])
    for i, (_, host, path, rule, verdict) in enumerate(cases):
        row = found[i]
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict), cases[i]


def test_decisions_reach_aliases(spark):
    rows = [
        (1, "http://a.org/1", canonical("http://x.net/es/9")),  # blocked through its canonical address
        (2, "http://b.org/2", canonical("//a.org/1")),  # and so is an alias of an alias
        (3, "http://c.org/dir/3", '<meta content="0; URL=4" http-equiv="refresh">'),
        (4, "http://c.org/dir/4", '<link rel="canonical" href=/5>'),
        (5, "http://c.org/5", canonical("http://y.net/fr/")),
        (6, "http://d.org/6", canonical("http://y.com/")),  # an explicit allow comes first
        (7, "http://d.org/7", canonical("http://d.org/6")),
        (8, "http://d.org/6b", canonical("http://z.net/es/")),
        (9, "http://z.net/es/", canonical("http://d.org/6")),
        (10, "http://e.org/10", canonical("http://e.org/11")),
        (11, "http://f.org/1?a=1#top", None),
        (12, "http://f.org/1?a=2", None),
        (None, "http://b.org/2", None),
    ]
    found = judged(spark, rows, [("http://f.org/1?a=1", "https://q.net/fr/"), ("http://f.org/1?a=3", None)])
    verdicts = {i: (row.verdict, row.decided_by) for i, row in found.items()}
    blocked = ("block", "alias")
    assert verdicts == {
        1: blocked, 2: blocked, 3: blocked, 4: blocked, 5: blocked, None: blocked,
        6: ("allow", "alias"), 7: ("allow", "alias"), 8: ("allow", "alias"), 9: ("block", "rule"),
        10: ("allow", "default"), 11: blocked, 12: ("allow", "default"),
    }


def test_empty_and_repeated(spark):
    assert judged(spark, [(1, "http://x.net/es/", None)] * 2).keys() == {1}
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert urls.judge(pages, URL_RULES).collect() == []
