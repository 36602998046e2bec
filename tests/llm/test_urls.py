import re

import pytest

from conftest import SF_SMALL
from lumisort.llm import queries, urls
from lumisort.llm.queries import URL_RULES


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path):
    best = None
    for action, rule in URL_RULES:
        h, slash, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (not best or len(rule) > len(best[1])):
            best = action, rule
    return best


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q#f", "http://example.net", "http://example.net/en",
        "http://example.net/en/", "x://example.com?/de/", "x://example.com/de/a", "x://example.com#/de/", "x://myorg/fr/",
        "x://org/fr/", "x://a.b.org/fr/x", "x://É.net/", "x://a.net//", "x://example.org/fr/y://z.net/", "://h.net/x"]


def test_hosts_paths_and_rules(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(URLS)], "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.url_verdicts(df, URL_RULES).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = split(u)
        best = fitting(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best[1]), u
        if best:
            assert got[i].verdict == best[0]


def brute_rank(links, seeds, damping, steps):
    total = {}
    for (a, _), n in links.items():
        total[a] = total.get(a, 0) + n
    score = dict(seeds)
    for _ in range(steps):
        now = {h: s * (1 - damping) for h, s in seeds.items()}
        for (a, b), n in links.items():
            if a in score:
                now[b] = now.get(b, 0) + damping * n / total[a] * score[a]
        score = now
    return score


def test_trust_and_distrust_propagate(spark):
    def page(i, url, *links):
        return i, url, "".join(f'<a href="{x}">x</a>' for x in links)
    rows = [page(1, "http://good.org/fr/1", "http://friend.com/a", "//friend.com/b", "/local"),
            page(2, "http://friend.com/x", "http://far.com/", "http://good.org/fr/1"),
            page(3, "http://bad.net/1", "http://friend.com/a"),
            page(4, "http://spam.com/1", "http://bad.net/1", "http://bad.net/2"),
            page(5, "http://spammer.com/1", "http://spam.com/1"), page(6, "http://alone.com/1"),
            page(7, "http://far.com/z"), page(8, "http://sub.spam.com/q")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in urls.url_verdicts(df, URL_RULES, steps=20).collect()}
    links = {("good.org", "friend.com"): 2, ("friend.com", "far.com"): 1, ("friend.com", "good.org"): 1,
             ("bad.net", "friend.com"): 1, ("spam.com", "bad.net"): 2, ("spammer.com", "spam.com"): 1,
             ("sub.spam.com", "spam.com"): 1, ("spam.com", "sub.spam.com"): 1}
    trust = brute_rank(links, {"good.org": 1.0}, 0.85, 20)
    distrust = brute_rank({(b, a): n for (a, b), n in links.items()}, {"bad.net": 1.0}, 0.85, 20)
    for r in got.values():
        assert r.trust == pytest.approx(trust.get(r.host, 0), abs=2e-3)
        assert r.distrust == pytest.approx(distrust.get(r.host, 0), abs=2e-3)
    assert {i: got[i].verdict for i in got} == {1: "allow", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow",
                                               7: "allow", 8: "block"}


def test_many_seeds_neither_end_the_walk_nor_hide_distrust(spark):
    rows = [(f"http://b{i}.net/x", None) for i in range(20_000)] + [(f"http://a{i}.org/fr/x", None) for i in range(20_000)]
    chain = ["b0.net", *(f"c{i}.com" for i in range(1, 11))]
    rows += [(f"http://{b}/", f'<a href="http://{a}/">') for a, b in zip(chain, chain[1:])]
    rows += [("http://often.com/", '<a href="http://b1.net/">' * 100_000), ("http://once.com/", '<a href="http://b1.net/">')]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: r for r in urls.url_verdicts(df, URL_RULES).where("host like '%.com'").collect()}
    assert len(got) == 12 and {r.verdict for r in got.values()} == {"block"}
    for k, host in enumerate(chain[1:], 1):  # a chain passes on what its seed has
        assert got[host].distrust == pytest.approx(0.85 ** k / 20_000 * 0.15, rel=1e-6)
    assert 0 < got["once.com"].distrust < 1e-9


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.QUERIES["op8_link_graph"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = split(pages[r.page_id])
        best = fitting(host, path)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        assert r.verdict == best[0] if best else r.verdict in ("allow", "block")


def test_odd_and_empty_tables(spark):
    schema = "page_id long, url string, html string, host string, verdict string, score double"
    rows = [(None, None, None, "x", "y", 1.0), (1, "http://a.com/", None, None, None, None),
            (1, "http://a.com/", None, None, None, None), (2, None, "<a href=http://a.com>", "q", "q", 0.0)]
    df = spark.createDataFrame(rows, schema)
    got = urls.url_verdicts(df, URL_RULES).collect()
    assert len(got) == 4 and all(r.verdict == "allow" for r in got)
    assert urls.url_verdicts(df.where("false"), URL_RULES).count() == 0
