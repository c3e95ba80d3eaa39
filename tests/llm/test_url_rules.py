import re
import time

import pytest
from pyspark.sql import functions as F

from limnia.llm import url_rules as ur

URLS = [
    None, "", "no scheme", "http://", "://x.org/a", "http://EXAMPLE.org/en/1", "http://example.org/en/12?x=/es/", "http://example.org/en/2",
    "http://a.example.org/es/", "http://example.org/ES/", "http://notexample.org/es/", "http://org/", "http://org", "http://x.org?/", "http://x.org#/",
    "http://x.com/fr/", "http://x.com/de/1#f", "http://x.com/de", "https://www.Casino.net/", "https://casinos-x.net/a", "http://mycasino.net/",
    "http://x.net/?a=1&SessionID=3", "http://x.net/a/b.EXE?x", "http://x.net/a.exes", "http://x.net/login", "http://x.net/a://y.org/", "http://x.net/\nline",
    "http://user@x.org:80/a", "http://é.org/é", "http://x.net/" + "a/" * 20000 + "casino", "http://x.net/wp-admin/",
    "http://x.net/?a=\nsessionid=3", "http://x.net/?a=\n&sessionid=3", "http://x.net/a\nb.exe",
]


def plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for r in ur.DECIDING:
        h, _, p = r.pattern.removeprefix("||").partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best, r, key=lambda x: len(x.pattern)) if best else r
    if best:
        return host, path, best.pattern.removeprefix("||"), best.verdict
    whole = re.sub("[A-Z]", lambda c: c[0].lower(), url.split("://", 1)[1]) if m else ""
    return host, path, None, "block" if any(re.search(ur.to_regex(r.pattern), whole, re.S) for r in ur.BLOCKING) else "allow"


def test_judge_equals_plain(spark):
    rows = [(i, u, "h", 1) for i, u in enumerate(URLS + URLS[:9])] + [(None, URLS[5], "h", 1)]
    out = ur.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule int"), ur.DECIDING + ur.BLOCKING)
    assert out.columns == ["page_id", "url", "host", "rule", "_host", "_path", "_rule", "_verdict"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["_host"], r["_path"], r["_rule"], r["_verdict"]) == plain(r["url"]), r["url"]


@pytest.mark.parametrize(
    "pattern,want",
    [("||org/", ["org"]), ("||example.org/en/1", ["en", "example", "org"]), ("^bets^", ["bets"]), ("?*sid=", []), ("a*b/c", []), (".exe^", ["exe"])],
)
def test_tokens(pattern, want):
    assert ur.tokens(pattern) == want


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert ur.judge(none, ur.DECIDING).collect() == []
    one = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    assert ur.judge(one, (ur.Rule("^nothing^", "block"),)).select(F.col("_verdict")).first()[0] == "allow"


def test_many_rules_cost_about_as_much_as_few(spark):
    urls = spark.range(20_000).selectExpr("id AS page_id", "concat('http://site', id % 500, '.net/path/', id, '/page?x=', id % 7) AS url")
    took = []
    for n in (10, 10, 5_000):
        rules = tuple(ur.Rule(f"/blocked{i}word/", "block") for i in range(n - 1)) + (ur.Rule("||site7.net/path/", "block"),)
        t = time.perf_counter()
        assert ur.judge(urls, rules).filter("_verdict = 'block'").count() == 40
        took.append(time.perf_counter() - t)
    assert took[2] < 3 * took[1] + 5
