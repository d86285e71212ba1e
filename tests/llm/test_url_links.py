"""Alias links of the URL filters: forms of links, and blocks along them against a plain version."""

from __future__ import annotations

import re
from urllib.parse import urljoin, urlsplit

import numpy as np

from cohortia.llm.queries import URL_RULES
from cohortia.llm.url_filters import filter_urls, page_links, url_key

BLOCKED = "http://b.net/fr/1"
CANON = '<link rel="canonical" href="{}">'


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "h", "b", 1) for r in rows], "page_id long, url string, html string, host string, key string, a int")


def test_links_in_every_form_reach_their_page(spark):
    rows = [(1, "http://Z.ORG/a", CANON.format(BLOCKED)), (2, "HTTP://q.org/1", CANON.format("http://z.org/a")),
            (3, "http://q.org/p?x=1", CANON.format(BLOCKED)), (4, "http://q.org/p?x=2", CANON.format("?x=1")),
            (5, "http://q.org/5", CANON.format("http://q.org/other") + "<p>" + CANON.format(BLOCKED)),
            (6, "http://q.org/6", f"<LINK href='{BLOCKED}' rel='nofollow Canonical'>"),
            (7, "http://q.org/d/e/7", CANON.format("../../6")), (8, "http://q.org/8", f"<link rel=canonical href={BLOCKED}>"),
            (9, "http://q.org/9", f'<meta http-equiv="x"><meta content="0; URL={BLOCKED}" http-equiv="Refresh">'),
            (10, "http://q.org/10", f'<link rel="canonicals" href="{BLOCKED}"><link data-rel="canonical" href="{BLOCKED}">'),
            (11, "http://q.org", CANON.format(BLOCKED)), (12, "http://q.org/", None), (13, "http://q.org/13", CANON.format("#top")),
            (14, "http://q.org/other", "x" * 300_000 + " <link " * 1000), (14, "http://q.org/other", ""), (None, None, CANON.format(BLOCKED))]
    got = [(r.page_id, r.verdict) for r in filter_urls(_frame(spark, rows), URL_RULES).collect()]
    allowed = {10, 13, None}
    assert sorted(got, key=str) == sorted(((i, "allow" if i in allowed else "block") for i, *_ in rows), key=str)
    assert filter_urls(_frame(spark, rows).limit(0), URL_RULES).count() == 0


def test_dots_resolve_as_in_urljoin(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(200):
        base = "http://s.org/" + "/".join(rng.choice(["a", "b", "c"], rng.integers(1, 4)))
        link = "/".join(rng.choice(["..", ".", "x", "y"], rng.integers(1, 5)))
        rows.append((i, base, CANON.format(link)))
    want = {(b, urljoin(b, re.search('href="(.*)"', h)[1])) for _, b, h in rows}
    want = {(a, b if urlsplit(b).path else b + "/") for a, b in want}
    got = {(r.a, r.b) for r in page_links(_frame(spark, rows)).collect()}
    assert got == {(a, b) for a, b in want if a != b}


def test_blocks_travel_like_a_plain_search(spark):
    rng = np.random.default_rng(4)
    urls = [f"http://h{i}.org/p" for i in range(120)] + [f"http://www.b.net/fr/{i}" for i in range(4)] + ["http://ok.com/x"]
    rows = [(i, u, "".join(CANON.format(urls[k]) for k in rng.integers(0, len(urls), rng.integers(0, 2)))) for i, u in enumerate(urls)]
    near = {u: {u} for u in urls}
    for _, u, h in rows:
        for v in re.findall('href="(.*?)"', h):
            near[u].add(v)
            near[v].add(u)
    reach = {u for u in urls if ".net/fr/" in u}
    while True:
        more = {v for u in reach for v in near[u]} | reach
        if more == reach:
            break
        reach = more
    want = {i: "block" if u in reach and not u.startswith("http://ok.com") else "allow" for i, u, _ in rows}
    got = filter_urls(_frame(spark, rows), URL_RULES).collect()
    assert {r.page_id: r.verdict for r in got} == want and 4 < sum(r.verdict == "block" for r in got) < 120


def test_keys(spark):
    pairs = {"HTTP://A.org": "http://a.org/", "http://A.org/B?C#d": "http://a.org/B?C", "no scheme#x": "no scheme",
             "http://a.org/x/../y/.": "http://a.org/y/", "http://a.org/../..": "http://a.org/", "http://a.org/a..b/.c": "http://a.org/a..b/.c"}
    frame = spark.createDataFrame([(k,) for k in pairs], "u string")
    assert {r.u: r.k for r in frame.select("u", url_key(frame.u).alias("k")).collect()} == pairs
