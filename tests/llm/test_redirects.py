from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow.parquet as pq

from weatherloom.llm import redirects
from weatherloom.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"
HABIT = re.compile(r"(utm_[a-z]+|gclid|fbclid|msclkid|mc_[ce]id|ref)=.*")
lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Links(HTMLParser):
    def __init__(self, url):
        super().__init__()
        self.base, self.found = url, []

    def handle_starttag(self, tag, attributes):
        at = {k: v or "" for k, v in reversed(attributes)}
        if tag == "base" and at.get("href"):
            self.base = urljoin(self.base, at["href"])
        if tag == "link" and "canonical" in at.get("rel", "").lower().split() and at.get("href"):
            self.found.append(at["href"].strip())
        if tag == "meta" and at.get("http-equiv", "").strip().lower() == "refresh":
            m = re.match(r"(?i)\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"']+)", at.get("content", ""))
            self.found += [m[1].strip()] if m else []


def split(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(lower), re.match(r"[^?#]*", rest[len(host) :])[0]


def address(url):
    if not url or "://" not in url:
        return None
    rest = url.split("://", 1)[1].strip(" ").split("#")[0]
    host = re.match(r"[^/?]*", rest)[0]
    name = re.sub(r"\.?(:(80|443))?$", "", host.rsplit("@", 1)[-1].translate(lower))
    path, _, search = rest[len(host) :].partition("?")
    return name + (path or "/") + ("?" + search if search else "") if name else None


def habit(a):
    path, _, search = a.partition("?")
    path = re.sub(r"\.html?$", "", re.sub(r"/index\.(html?|php)$", "/", path))
    path = path[:-1] if re.match(r"[^/]+/.*[^/]/$", path) else path
    search = "&".join(x for x in search.split("&") if not HABIT.fullmatch(x))
    return path + ("?" + search if search else "")


def plain(pages, rules, observed=()):
    def rule(host, path):
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        return max(fits, key=lambda r: (len(r.host + r.path), len(r.host), r.allow), default=None)

    up, say = {}, {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    def note(url):
        if a := address(url):
            if r := rule(*split(url)):
                say.setdefault(a, set()).add(r.allow)
            form = habit(a)
            if r := rule(*split("x://" + form)):
                say.setdefault(form, set()).add(r.allow)
            up[top(a)] = top(form)
        return a

    links = list(observed)
    for _, url, html in pages:
        if note(url) and html:
            reader = Links(url)
            reader.feed(html)
            links += [(url, urljoin(reader.base, x)) for x in reader.found]
    for x, y in links:
        a, b = note(x), note(y) if re.match(r"(?i)https?://", y) else None
        if a and b:
            up[top(a)] = top(b)
    groups = {}
    for a, said in say.items():
        groups.setdefault(top(a), set()).update(said)
    out = []
    for page, url, _ in pages:
        own, a = rule(*split(url)), address(url)
        allowed = own.allow if own else True not in (said := groups.get(top(a), {True}) if a else {True}) and False or True in said
        out.append((page, *split(url), own and own.host + own.path, "allow" if allowed else "block"))
    return sorted(map(repr, out))


def got(rows, rules):
    return sorted(
        repr((r.page_id, r.host, r.path, None if r.rule is None else rules[r.rule].host + rules[r.rule].path, "allow" if r.allowed else "block"))
        for r in rows
    )


def link(to):
    return f'<html><head><LINK href="{to}" REL="canonical"></head></html>'


PAGES = [
    (1, "http://a.org/x", link("http://shop.net/es/1")),  # alias of a blocked one
    (2, "https://b.org/y?ref=1", None),
    (3, "https://b.org/y", link("//A.org/x#frag")),
    (4, "https://c.org/z", link("https://ok.com/z")),  # alias of an allowed and, below, of a blocked one
    (5, "https://bad.net/fr/2", link("https://c.org/z")),
    (6, "https://d.org/deep/page.html", "<meta http-equiv=refresh content='0; URL=../up/./q'>"),
    (7, "https://d.org/up/q/", '<meta content="5;url=https://e.net/es/?a=1&amp;b=2" http-equiv="Refresh">'),
    (8, "https://f.org/1", "<!-- " + link("http://shop.net/es/1") + " --><script>var x = '" + link("http://shop.net/es/1") + "'</script>"),
    (9, "https://f.org/2", link("javascript:void(0)") + link("mailto:x@shop.net") + link("#top") + link("ftp://shop.net/es/1")),
    (10, "https://g.org/s/p", "<base href='https://shop.net/es/'>" + link("1")),
    (11, "HTTP://WWW.Example.COM/en/1", None),
    (12, "http://sub.example.com:8080/en/1", None),
    (13, "http://example.com/en/1", None),
    (14, "http://example.com", None),
    (15, "http://shop.net/de/", link("/es/1")),
    (16, "http://shop.net/de/?q", link("?r")),
    (17, None, link("http://shop.net/es/1")),
    (18, "no scheme", link("http://shop.net/es/1")),
    (19, "", None),
    (20, "://", None),
    (21, "http:///es/", None),
    (1, "http://a.org/x", None),
    (None, "http://a.org/x/", ""),
    (22, "https://h.org/" + "a" * 3000, link("https://a.org/x")),
    (23, "http://xnet/es/", None),
    (24, "http://net/es/", None),
    (25, "http://i.org/r", None),
    (26, "https://user@j.org:443/k/index.html", link("https://shop.net/fr/9")),
    (27, "https://j.org/k", "text " * 30_000),
]


def test_against_plain(spark):
    frame = spark.createDataFrame([(*p, 1, 2, 3, 4) for p in PAGES], "page_id long, url string, html string, node int, rule int, root int, a int")
    observed = [("http://i.org/r", "http://shop.net/es/1"), ("http://k.org/", "x"), (None, "http://shop.net/es/1")]
    table = spark.createDataFrame(observed, "url string, target string")
    rows = redirects.judge(frame, URL_RULES, table).collect()
    assert got(rows, URL_RULES) == plain(PAGES, URL_RULES, [o for o in observed if o[0]])
    verdict = {r.page_id: r.allowed for r in rows}
    blocked = {1, 2, 3, 5, 6, 7, 10, 13, 15, 22, 24, 25, 26, 27, None}
    assert {k for k, v in verdict.items() if not v} == blocked


def test_a_hub_and_a_chain(spark):
    pages = [(i, f"http://p{i}.org/", link("http://hub.org/")) for i in range(300)]
    pages += [(1000 + i, f"http://q.org/{i}", link(f"/{i + 1}")) for i in range(6)] + [(1006, "http://q.org/6", link("http://x.net/fr/1"))]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert got(redirects.judge(frame, URL_RULES).collect(), URL_RULES) == plain(pages, URL_RULES)


def test_no_pages_and_no_rules(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert redirects.judge(none, URL_RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/es/", None)], "page_id long, url string, html string")
    assert [tuple(r) for r in redirects.judge(one, []).collect()] == [(1, "http://a.net/es/", "a.net", "/es/", None, True)]


def test_longest_rule_then_longer_host_then_allow(spark):
    rules = [redirects.Rule("a.com", "/x", False), redirects.Rule("com", "/x/yz", True), redirects.Rule("b.com", "/", False), redirects.Rule("b.com", "/", True)]
    pages = [(1, "http://a.com/x/yzw", None), (2, "http://a.com/x", None), (3, "http://b.com/", None)]
    found = {r.page_id: r.rule for r in redirects.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    assert found == {1: 1, 2: 0, 3: 3}


def test_query_against_plain(spark):
    pages = [(r["page_id"], r["url"], r["html"]) for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()]
    rows = QUERIES["op13_url_filters"](spark, SF).collect()
    assert sorted(repr((r.page_id, r.host, r.path, r.rule, r.verdict)) for r in rows) == plain(pages, URL_RULES)
