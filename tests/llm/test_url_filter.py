import re

from pyspark.sql import functions as F

from llm.url_filter import RULES, UrlRule, general_path, judge_urls
from tests.llm.odd import LOWER

PAGES = "page_id bigint, url string, Template string"


def brute_rule(url, rules=RULES):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (found[1].translate(LOWER), found[2]) if found else ("", "")
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name)) if fits else None


def judged(spark, urls, **settings):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], PAGES)
    rows = judge_urls(df, **settings).collect()
    assert sorted(r.page_id for r in rows) == list(range(len(urls)))
    return {r.page_id: r for r in rows}


def test_rules_and_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "://", "http://A.COM", "http://A.COM/x", "https://www.example.com/en/1", "http://example.com/en/",
        "http://m.example.com/en/a?b#c", "http://x.www.example.com/en/", "http://xexample.com/en/", "ftp://q.net/es/#f", "http://q.net/es",
        "http://net/fr/://other.com/", "http://q.net:80/es/", "http://q.org?x=://z.com/", "http://q.org/" + "a/" * 50_000,
        "http://dup.org/a", "http://dup.org/a", "http://ünï.org/é/\n/z",
    ]
    got = judged(spark, urls)
    for i, url in enumerate(urls):
        host, path, rule = brute_rule(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.name), url
        assert got[i].verdict == (rule.verdict if rule else "allow"), url
    assert judge_urls(spark.createDataFrame([], PAGES)).collect() == []


def test_numbers_and_hexadecimal_names(spark):
    paths = ["/en/12/", "/a1b2-3.html", "/deadbeef01/x", "/deadbeef/x", "/0123456789abcdef", ""]
    df = spark.createDataFrame([(p,) for p in paths], "p string").select(general_path(F.col("p")))
    assert [r[0] for r in df.collect()] == ["/en/#/", "/a#b#-#.html", "/#/x", "/deadbeef/x", "/#", ""]


def test_alike_branches_share_their_labels(spark):
    rules = (UrlRule("block", "a.org", "/x/"), UrlRule("block", "a.org", "/y1/"))
    urls = [f"http://a.org/y{i % 3}/{n}" for n, i in enumerate(range(30))] + [f"http://a.org/z/{n}/deep" for n in range(9)]
    got = judged(spark, urls, rules=rules)
    # y0, y1 and y2 are one segment after their numbers; z ends otherwise and stays apart.
    assert {r.template for i, r in got.items() if i < 30} == {"/y#/#"}
    assert all(r.verdict == "block" and r.purity < 0.4 for i, r in got.items() if i < 30)
    assert all(r.verdict == "allow" and r.template == "/z/#/deep" for i, r in got.items() if i >= 30)


def test_branches_merge_by_shape_and_labels(spark):
    urls, good = [], []
    for branch, label in (("a", True), ("b", True), ("c", False), ("d", None), ("e", None)):
        urls += [f"http://h.org/{branch}/{n}" for n in range(12)]
        good += [label] * 12
    df = spark.createDataFrame(list(zip(range(60), urls, good)), "page_id int, url string, fine boolean")
    got = {r.url.split("/")[3]: (r.template, r.verdict) for r in judge_urls(df, rules=(), good="fine").collect()}
    assert got == {
        "a": ("/(a|b)/#", "allow"), "b": ("/(a|b)/#", "allow"), "c": ("/c/#", "block"),
        "d": ("/(d|e)/#", "allow"), "e": ("/(d|e)/#", "allow"),
    }


def test_many_segments_become_the_wildcard(spark):
    names = ["".join(chr(97 + int(d)) for d in str(n)) for n in range(100, 400)]
    urls = [f"http://h.org/{n}/page" for n in names] + ["http://h.org/often/page"] * 100
    df = spark.createDataFrame([(i, u, None if i % 2 else False) for i, u in enumerate(urls)], "page_id int, url string, fine boolean")
    rows = judge_urls(df, rules=(), good="fine").collect()
    assert {r.template for r in rows if "often" not in r.url} == {"/*/page"}
    # Half of the segments are labelled bad; the others share their template and go with them.
    assert {r.verdict for r in rows if "often" not in r.url} == {"block"}
    assert {r.template for r in rows if "often" in r.url} == {"/often/page"}


def test_no_python_on_the_path(spark):
    df = judge_urls(spark.createDataFrame([(1, "http://a.b/c")], "page_id int, url string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
