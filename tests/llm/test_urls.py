import re

import numpy as np
import pytest

from snapsync.llm import urls
from snapsync.llm.queries import URL_RULES


def parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("", "") if not m else ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2])


def rule(url):
    host, path = parts(url)
    best = None
    for verdict, text in URL_RULES:
        name, slash, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            if best is None or len(text) > len(best[1]):
                best = (verdict, text)
    return best


URLS = [
    None, "", "no scheme", "http://A.Example.NET/en/x?y", "https://example.net/de/", "ftp://net/", "http://net",
    "http://subnet/", "http://x.example.com/de/1#a/b", "http://example.com/en/?u=http://b.net/", "://h.org/fr/",
    "http://h.org/fr/a\nb", "http://h.org/fr?x", "http://ÄB.org/fr/", "http://h.org#http://x.net/", "a://b://c.net/",
]


@pytest.fixture()
def pages(spark, documents):
    documents([])
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, rule int, host int")


def test_hosts_paths_and_rules(pages):
    rows = [(i, u, None, 0, 0) for i, u in enumerate(URLS)] + [(None, URLS[3], "", 0, 0)] * 2
    found = urls.filter_urls(pages(rows), URL_RULES).collect()
    assert len(found) == len(rows)
    for r in found:
        url = URLS[r.id if r.id is not None else 3]
        assert (r.host, r.path) == parts(url)
        want = rule(url)
        assert r.rule == (want and want[1])
        assert r.verdict == want[0] if want else r.verdict in ("allow", "block")
    assert urls.filter_urls(pages([]), URL_RULES).count() == 0


def test_rings_of_links_are_followed_to_the_end(pages):
    """Six hosts link to a blocked one; one of them is in a ring with another host, where distrust adds up."""
    links = {f"h{i}.com": ["x.net"] for i in range(5)} | {"a.com": ["x.net", "b.com"], "b.com": ["a.com"], "x.net": []}
    rows = [
        (i, f"http://{host}/fr/", "".join(f'<a href="//{t}/">' for t in targets), 0, 0)
        for i, (host, targets) in enumerate(links.items())
    ]
    found = {r.host: r for r in urls.filter_urls(pages(rows), URL_RULES).collect()}
    # Distrust of a.com: its share of x.net's, and what comes round by b.com.
    want = 0.15 * 0.85 / 6 / (1 - 0.85**2)
    assert abs(found["a.com"].distrust - want) < urls.TOLERANCE
    assert found["a.com"].distrust >= urls.BLOCKED_FROM and found["a.com"].verdict == "block"
    assert found["h0.com"].verdict == "allow"


def test_trust_is_the_personalised_rank(pages):
    links = {
        "a.net": ["b.com", "c.com", "c.com"], "b.com": ["a.net", "x.org"], "c.com": ["x.org"],
        "d.com": ["a.net"], "x.org": ["b.com"],
    }
    rows = []
    for i, (host, targets) in enumerate(links.items()):
        html = "".join(f'<a HREF="HTTP://{t.upper()}/p">x</a><a href="/own">' for t in targets)
        rows.append((i, f"http://{host}/fr/", html, 0, 0))
    found = {r.host: r for r in urls.filter_urls(pages(rows), URL_RULES, rounds=10).collect()}
    hosts = sorted(links)
    n = np.array([[links[a].count(b) for b in hosts] for a in hosts], float)
    for name, seed_host, move in (("trust", "x.org", n), ("distrust", "a.net", n.T)):
        seed = np.array([float(h == seed_host) for h in hosts])
        p = move / np.maximum(move.sum(1, keepdims=True), 1)
        want = 0.15 * seed
        for _ in range(10):
            want = 0.15 * seed + 0.85 * p.T @ want
        assert np.allclose([found[h][name] for h in hosts], want)
    assert found["d.com"].verdict == "block" and found["d.com"].rule is None
