import re

import pytest

from kpiloom.llm.queries import URL_RULES
from kpiloom.llm.url_filter import DEFAULT_BLOCKS, UrlRule, rule_table, url_filter

URLS = [None, "", "no scheme", "http://", "http://net", "http://net/", "HTTP://A.Example.NET/en/x?y#z", "http://example.net/EN/", "http://xexample.com/de/",
        "http://a.b.example.com/de/1", "http://x.org/fr/", "http://x.org/fr", "http://org/fr/2", "https://user@x.net:80/a", "http://x.net:80/a",
        "http://foo.net?q=://x", "http://a.net/b#c", "http://m.spam-farm.example.com/en/", "http://my-spam-farm.example.com/", "http://x.com/a/wp-login.php",
        "http://spam-farm.example.net/en/", "http://x.net/a/b://c/d"]


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    best = None
    for rule, verdict in (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")):
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    if best:
        return host, path, best[0], best[1]
    bad = any(("." + host + path).find("." + r.pattern) >= 0 and ("." + host).find("." + r.pattern) >= 0 if r.pattern[0] != "*" else r.pattern[1:] in host + path
              for r in DEFAULT_BLOCKS)
    return host, path, None, "block" if bad else "allow"


def test_matches_brute_force(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(3, "http://net/")], "page_id long, url string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter(pages, rule_table(spark, [*URL_RULES, *DEFAULT_BLOCKS])).collect()), key=repr)
    assert got == sorted(((i, *brute(u)) for i, u in [*enumerate(URLS), (3, "http://net/")]), key=repr)


def test_rules_without_a_token_and_ties(spark):
    pages = spark.createDataFrame([(1, "http://abc.com/x"), (2, None)], "page_id long, url string")
    rules = rule_table(spark, [UrlRule("*b*", "block", 1), UrlRule("*c*", "allow", 1)])
    assert UrlRule("*b*", "block").tokens() == []
    rows = {r.page_id: (r.rule, r.verdict) for r in url_filter(pages, rules).collect()}
    assert rows == {1: ("*c*", "allow"), 2: (None, "allow")}


@pytest.mark.parametrize("pattern, tokens", [("example.net/en/", ["en", "example", "net"]), ("spam-farm.", ["farm", "spam"]),
                                             ("net", []), ("*ads.x*y.z/", ["z"])])
def test_tokens(pattern, tokens):
    assert UrlRule(pattern, "block").tokens() == tokens


def test_empty_table_clashing_columns_and_plan(spark):
    rules = rule_table(spark, list(URL_RULES))
    assert url_filter(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    odd = spark.createDataFrame([(1, "http://a.net/", "h", "t")], "page_id long, url string, host string, token string")
    out = url_filter(odd, rules)
    assert out.first().host == "a.net"
    assert not re.search("Python|Arrow|Pandas|Cartesian", out._jdf.queryExecution().executedPlan().toString())
