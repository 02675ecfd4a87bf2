import re

import pytest
from helpers import by_id

from pairloom.llm import urls
from pairloom.llm.queries import URL_RULES


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")


def page(i, url, html=""):
    return i, url, html, "x", "x"


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    best = None
    for r in URL_RULES:
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path) and (best is None or len(r.rule) > len(best.rule)):
            best = r
    return host, path, best and best.rule, best and best.verdict


def test_rules(spark):
    found = [None, "", "no scheme", "http://", "http://com/", "http://a.com", "http://a.com/x?y=/en/", "HTTP://WWW.Example.COM/en/1#x", "https://example.com/en/", "https://badexample.com/en/1",
             "https://m.example.com/en/1", "https://m.www.example.com/en/1", "x://a.net/es/1", "x://a.net/ES/1", "x://net/fr/", "x://a.net?/fr/", "x://a.com:80/y", "a://b://c.com/", "http://É.com/ß", "http://a.org/fr/"]
    rows = [page(i, u) for i, u in enumerate(found)]
    got = by_id(urls.judge(pages(spark, rows + rows[:2]), URL_RULES))
    for i, url in enumerate(found):
        host, path, rule, verdict = plain(url)
        assert got[i][:3] == (host, path, rule), url
        assert got[i][3] == (verdict or "allow"), url
    assert urls.judge(pages(spark, rows + rows[:2]), URL_RULES).count() == len(rows) + 2


def test_trust_and_distrust_follow_links(spark):
    def link(*hosts):
        return "".join(f'<a class="x" href="https://{h}/p">y</a>' for h in hosts)

    rules = (urls.HostRule("allow", "good.test/"), urls.HostRule("block", "bad.test/"))
    rows = [page(1, "http://good.test/", link("friend.test", "mixed.test")), page(2, "http://bad.test/", link("victim.test")), page(3, "http://farm.test/", link("bad.test", "BAD.test")),
            page(4, "http://friend.test/", link("other.test")), page(5, "http://victim.test/"), page(6, "http://other.test/"), page(7, "http://mixed.test/", link("bad.test", "friend.test", "other.test", "x.test")), page(8, "http://lone.test/")]
    got = {r.page_id: r.verdict for r in urls.judge(pages(spark, rows), rules).collect()}
    assert got == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow"}


def test_no_rows(spark):
    assert urls.judge(pages(spark, []), URL_RULES).count() == 0


@pytest.mark.parametrize("blocked", [1, 10, 300])
def test_a_farm_is_blocked_however_many_hosts_are(spark, blocked):
    """With the query's own parameters: farms that link to one blocked host each, and one that links to all."""
    rules = (urls.HostRule("allow", "good.test/"), urls.HostRule("block", "bad.test/"))
    link = lambda *hosts: "".join(f'<a href="//{h}/">x</a>' for h in hosts)
    rows = [page(i, f"http://b{i}.bad.test/") for i in range(blocked)]
    rows += [page(10_000 + i, f"http://farm{i}.test/", link(f"b{i}.bad.test")) for i in range(min(blocked, 10))]
    rows += [page(20_000, "http://all.test/", link(*(f"b{i}.bad.test" for i in range(blocked)))), page(20_001, "http://good.test/", link("clean.test")),
             page(20_002, "http://clean.test/", link(*(f"site{i}.test" for i in range(20))))]
    got = {r.page_id: r.verdict for r in urls.judge(pages(spark, rows), rules).filter("page_id >= 10000").collect()}
    assert all(got[10_000 + i] == "block" for i in range(min(blocked, 10)))
    assert got[20_000] == "block" and got[20_001] == "allow" and got[20_002] == "allow"


def test_long_urls_and_pages_and_repeated_ids(spark):
    long = "http://a.net/es/" + "x" * 300_000
    rows = [page(1, long, "<a href=//b.test>" * 20_000), page(1, "http://www.example.com/en/"), page(2, "no scheme " * 30_000)]
    got = sorted((r.page_id, len(r.path), r.rule, r.verdict) for r in urls.judge(pages(spark, rows), URL_RULES).collect() if r.page_id == 1)
    assert got == [(1, 4, "www.example.com/en/", "allow"), (1, len(long) - 12, "net/es/", "block")]
