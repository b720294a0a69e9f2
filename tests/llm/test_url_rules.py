"""Rules of op1's contract, kept here in its own words, against plain Python on the query's rows."""

import itertools
import re

from pyspark.sql import functions as F

from waymark.llm.queries import QUERIES

CONTRACT = "block com/en/, allow example.com/en/7, allow net/de/, block example.net/de/8, block org/es/"
SMALL = "/root/testdata/sf0.01"


def expected(url):
    """(host, path, rule, the rule's verdict) by the contract."""
    host, path = re.match(r"([^/?#]*)([^?#]*)", (url or "").partition("://")[2]).groups()
    host = host.translate({i: i + 32 for i in range(65, 91)})
    best, word = "", None
    for action, rule in (r.split() for r in CONTRACT.split(", ")):
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and len(rule) > len(best):
            best, word = rule, action
    return host, path, best or None, word


def wrong(out, pages):
    """Rows whose host, path, rule or, where a rule fits, verdict is not the contract's; how many rules' words there are."""
    want = {i: expected(u) for i, u in pages}
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in out.collect()}
    assert got.keys() == want.keys() and {v for *_, v in got.values()} <= {"allow", "block"}
    return {i: (got[i], w) for i, w in want.items() if got[i][:3] != w[:3] or w[3] and got[i][3] != w[3]}, {w[2:] for w in want.values()}


def test_every_rule_has_its_word_on_the_given_pages(spark):
    pages = [tuple(x) for x in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    bad, words = wrong(QUERIES["op1_url_markov_ratio"](spark, SMALL), pages)
    assert not bad
    assert words == {(None, None), ("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block")}


def test_every_rule_at_its_edges(spark, tmp_path):
    """All hosts by all paths, among enough seeded urls that the method blocks some: its word must not outrank a rule's."""
    hosts = ["com", "COM", "example.com", "a.Example.com", "notexample.com", "net", "x.net", "example.net", "A.b.EXAMPLE.NET", "myexample.net", "casino-win.net", "ads.example.com", "org", "a.org", "xorg", "net:80", "u@example.net", ""]
    paths = ["", "/", "/en", "/en/", "/en/7", "/en/78?x=1", "/de", "/de/", "/de/7", "/de/8", "/de/80#y", "/De/8", "/x/de/8", "/de/8\nz", "/es/", "/es/1?://example.net/de/8", "?/de/8", "#/de/8"]
    urls = [f"http://{h}{p}" for h, p in itertools.product(hosts, paths)] + [None, "", "net/de/", "://example.net/de/8", "a://net/de/x://org/es/"]
    urls += [f"http://casino-win{i}.ads.info/win?{i * 7919 % 1000}" for i in range(150)]
    pages = list(enumerate(urls))
    spark.createDataFrame(pages, "page_id long, url string").withColumn("html", F.lit("")).write.parquet(f"{tmp_path}/pages.parquet")
    out = QUERIES["op1_url_markov_ratio"](spark, str(tmp_path))
    bad, words = wrong(out, pages)
    assert not bad and len(words) == 6
    assert out.where("rule is null and verdict = 'block'").count() > 0
