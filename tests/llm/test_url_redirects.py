from footfall.llm.queries import URL_RULES
from footfall.llm.url_redirects import Rule, judge_pages


def page(i, url, canonical=None, refresh=None):
    html = "<html><head>"
    html += f'<link href="{canonical}" rel="canonical">' if canonical else ""
    html += f"<META HTTP-EQUIV=refresh content='0; url={refresh}'>" if refresh else ""
    return i, url, html


PAGES = [
    page(1, "http://Sub.Example.NET/x?q#f"), page(2, "https://example.net/en/a"), page(3, "https://example.com/de/"),
    page(4, "https://a.org/fr/x"), page(5, "https://a.org"), page(6, None), page(7, "nonsense"), page(8, "http://net"),
    page(9, "http://net/"), page(10, "HTTP://EXAMPLE.COM/DE/"),
    # aliases: 20 -> 21 -> blocked; 22 is canonical for 20 too
    page(20, "http://one.io/a", refresh="http://two.io/b"), page(21, "http://two.io/b#x", canonical="http://bad.net/"),
    page(22, "http://three.io/c", canonical="//one.io/a"),
    # a component with an explicit allow
    page(30, "http://four.io/a", canonical="http://bad.net/other"), page(31, "http://five.io/", refresh="http://four.io/a"),
    page(32, "http://x.org/fr/ok", canonical="http://five.io"),
    # relative links
    page(40, "http://six.io/d/e", canonical="f"), page(41, "http://six.io/d/f", canonical="/g?z=1"), page(42, "https://six.io/g?z=1", refresh="http://w.net/"),
    page(43, "http://six.io/g"), page(20, "http://one.io/a", refresh="http://two.io/b"), (50, "http://seven.io/", None),
]


def test_verdicts(spark):
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    got = judge_pages(rows, URL_RULES).collect()
    assert len(got) == len(PAGES)
    by = {r["page_id"]: r for r in got}
    assert [(by[i]["host"], by[i]["path"], by[i]["rule"], by[i]["verdict"]) for i in range(1, 11)] == [
        ("sub.example.net", "/x", "net/", "block"), ("example.net", "/en/a", "example.net/en/", "allow"),
        ("example.com", "/de/", "example.com/de/", "block"), ("a.org", "/fr/x", "org/fr/", "allow"),
        ("a.org", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("net", "", None, "allow"),
        ("net", "/", "net/", "block"), ("example.com", "/DE/", None, "allow"),
    ]
    assert {i: by[i]["verdict"] for i in by if i >= 20} == {
        20: "block", 21: "block", 22: "block", 30: "allow", 31: "allow", 32: "allow", 40: "block", 41: "block", 42: "block",
        43: "allow", 50: "allow",
    }


def test_crawled_redirects_clashing_columns_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.io/", "p", "v")], "page_id long, url string, html string, verdict string")
    moved = spark.createDataFrame([("http://a.io", "http://b.net/"), (None, "http://c.net/")], "from_url string, to_url string")
    out = judge_pages(rows, URL_RULES, moved)
    assert out.columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert out.first()["verdict"] == "block"
    assert judge_pages(rows, [Rule("allow", "io", "/"), Rule("block", "a.io", "/")]).first()["rule"] == "a.io/"
    assert judge_pages(rows.limit(0), URL_RULES).count() == 0
