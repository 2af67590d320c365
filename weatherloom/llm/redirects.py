"""URL filters that hold for a page under all of its names.

Rules name a host and the start of a path. A URL without a rule of its own takes part in what
redirects and canonical links say: those are edges between addresses, and distributed connected
components over them are the aliases of one resource. A block on one alias holds for all of them,
unless one of them is explicitly allowed.

An address is a URL without scheme and fragment, its host in lower case without default port. Edges
come from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` of the pages, from a table of
observed redirects if there is one, and from the redirects that sites answer by habit: a trailing
slash, an index file, ``.html``, and parameters that only track.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.components import components
from weatherloom.llm.scratch import written
from weatherloom.llm.text import UPPER


class Rule(NamedTuple):
    host: str
    path: str
    allow: bool


#: Rules become one expression; a longer list belongs into a table.
MAX_RULES = 1000
_TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|msclkid|mc_[ce]id|ref)"


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def host_path_of(rest: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path of what follows ``://`` in a URL; both empty for null."""
    whole = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(whole, r"^([^/?#]*)", 1)
    return _lower(host), F.regexp_extract(whole, r"^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as its number in ``rules``; null if none does.

    Of rules of equal length the one of the longer host goes first, then an allowing one.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules: join a table of rules instead")
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i].host + rules[i].path), -len(rules[i].host), not rules[i].allow, i))
    number = F.lit(None).cast("int")
    for i in reversed(order):
        fits = ((host == rules[i].host) | host.endswith(f".{rules[i].host}")) & path.startswith(rules[i].path)
        number = F.when(fits, F.lit(i)).otherwise(number)
    return number


def _resolved(base: Column, link: Column) -> Column:
    """What follows the scheme of ``link`` as seen on the page whose URL without scheme is ``base``."""
    host = F.regexp_extract(base, r"^([^/?#]*)", 1)
    path = F.regexp_extract(base, r"^[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path, r"^/?(.*/)?[^/]*$", 1))
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.when(link.rlike(r"^[Hh][Tt][Tt][Pp][Ss]?://"), after_scheme(link)))
        .when(link.startswith("//"), F.substring(link, 3, F.length(link)))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))  # mailto:, javascript:
        .when(link.startswith("/"), F.concat(host, link))
        .when(link.startswith("?"), F.concat(host, path, link))
        .when(link.startswith("#") | (link == ""), base)
        .otherwise(F.concat(host, folder, link))
    )


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` parts."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done))
        .otherwise(F.concat(done, F.array(part))),
    )
    ends = path.rlike(r"/\.\.?$")
    plain = F.array_join(F.when(ends, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(path.contains("/."), plain).otherwise(path)


def address(rest: Column) -> Column:
    """The address of a URL without scheme: no fragment, no default port, lower host; null without host."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(rest), "#.*$", ""), r"^[^/?#@]*@", "")
    host = F.regexp_replace(_lower(F.regexp_extract(bare, r"^([^/?]*)", 1)), r"\.?(?::(?:80|443))?$", "")
    path = F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1)
    path = F.when(path == "", F.lit("/")).otherwise(_without_dots(path))
    return F.when(host != "", F.concat(host, path, F.regexp_extract(bare, r"^[^?]*(\?.+)?$", 1)))


def usual_form(of: Column) -> Column:
    """The address that sites redirect ``of`` to by habit."""
    path, search = F.regexp_extract(of, r"^([^?]*)", 1), F.regexp_extract(of, r"^[^?]*\?(.*)$", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/index\.(?:html?|php)$", "/"), r"\.html?$", "")
    path = F.regexp_replace(path, r"^([^/]+/.*[^/])/$", "$1")  # the root keeps its slash
    search = F.regexp_replace(F.regexp_replace(search, f"(?:^|&){_TRACKING}=[^&]*", ""), "^&+", "")
    return F.concat(path, F.when(search == "", F.lit("")).otherwise(F.concat(F.lit("?"), search)))


def _key(of: Column) -> Column:
    """126 bits that name an address, as a number, whose minimum needs no sort."""
    half = F.xxhash64(F.lit(0), of).bitwiseAND((1 << 62) - 1).cast("decimal(38,0)")
    return (F.xxhash64(F.lit(1), of).bitwiseAND((1 << 62) - 1).cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + half).cast("decimal(38,0)")


def _attribute(tag: Column, name: str) -> Column:
    pattern = rf"(?is)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def _said(pages: DataFrame) -> DataFrame:
    """(base, link) of the canonical links and refreshes in the pages' heads."""
    plain = F.regexp_replace(F.col("html"), r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", "")
    tags = F.regexp_extract_all(plain, F.lit(r"(?is)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    tag = F.col("tag")
    is_base = F.filter("tags", lambda t: t.rlike(r"(?i)^<base\b"))
    canonical = tag.rlike(r"(?i)^<link\b") & F.concat(F.lit(" "), _lower(_attribute(tag, "rel")), F.lit(" ")).rlike(r"\scanonical\s")
    refresh = tag.rlike(r"(?i)^<meta\b") & (_lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
    to = F.when(canonical, _attribute(tag, "href")).when(
        refresh, F.regexp_extract(_attribute(tag, "content"), r"(?is)^\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"']+)", 1)
    )
    return (
        pages.where("html is not null").where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
        .select(after_scheme(F.col("url")).alias("base"), tags.alias("tags")).where("base is not null")
        .withColumn("home", F.coalesce(F.get(is_base, 0), F.lit("")))
        .withColumn("home", F.when(F.col("home") != "", _resolved(F.col("base"), F.trim(_attribute(F.col("home"), "href")))))
        .select(F.col("base").alias("page"), F.coalesce("home", "base").alias("base"), F.explode("tags").alias("tag"))
        .select("page", "base", F.trim(F.replace(to, F.lit("&amp;"), F.lit("&"))).alias("link"))
        .where("link <> ''").select("page", _resolved(F.col("base"), F.col("link")).alias("target"))
    )


def edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """(u, v, target) between addresses: what the pages say, what was observed, and usual redirects.

    ``redirects`` are (url, target), absolute. Links without a host, to other schemes, or to the
    page itself are none.
    """
    said = _said(pages)
    if redirects is not None:
        said = said.union(redirects.select(after_scheme(F.col("url")), after_scheme(F.col("target"))))
    said = said.select(address(F.col("page")).alias("a"), address(F.col("target")).alias("b"))
    own = pages.select(address(after_scheme(F.col("url"))).alias("a"))
    ends = said.select("a").union(said.select("b")).union(own).where("a is not null").select("a", usual_form(F.col("a")).alias("b"))
    return (
        said.union(ends).where("a <> b").select(_key(F.col("a")).alias("u"), _key(F.col("b")).alias("v"), "a", "b")
    )


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, allowed) of every row of ``pages`` (page_id, url, html, ...).

    ``rule`` is the number of the longest rule that fits the page's own URL, and decides. Other
    pages are blocked where an alias of theirs is blocked and none is allowed. A null URL, or one
    without ``://``, has an empty host and path, no alias, and is allowed unless a rule fits that.
    Null html says nothing. Repeated rows come back as often as they came; other columns are ignored.
    """
    rest = after_scheme(F.col("url"))
    host, path = host_path_of(rest)
    pages = pages.select("page_id", "url", "html")
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"), address(rest).alias("address")).withColumn(
        "rule", fitting_rule(F.col("host"), F.col("path"), rules)
    )
    verdict = F.get(F.array(*[F.lit(r.allow) for r in rules]), F.col("rule")) if rules else F.lit(None).cast("boolean")
    ruled = own.where("rule is not null or address is null").select(
        "page_id", "url", "host", "path", "rule", F.coalesce(verdict, F.lit(True)).alias("allowed")
    )
    found = written(edges(pages, redirects), "edges")
    roots = written(components(found.select("u", "v")), "aliases")
    # what the rules say of an address: of the pages' URLs and of the targets they name
    named = own.select("address", "host", "path").where("address is not null")
    for end in ("a", "b"):
        h, p = host_path_of(F.col(end))
        named = named.union(found.select(F.col(end), h, p))
    spoken = written(
        named.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules)).where("rule is not null")
        .select(_key(F.col("address")).alias("node"), verdict.alias("allow")).groupBy("node").agg(F.max("allow").alias("allow")),
        "spoken",
    )
    blocked_roots = written(
        spoken.join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "allow")
        .groupBy("root").agg(F.max("allow").alias("allow")).where("not allow").select("root"),
        "blocked-roots",
    )
    # a root is its own alias, also where nothing links to it
    blocked = written(roots.join(blocked_roots, "root").select("node").union(blocked_roots.select("root")).distinct(), "blocked")
    rest_pages = (
        own.where("rule is null and address is not null").withColumn("node", _key(F.col("address")))
        .join(blocked.withColumn("blocked", F.lit(True)), "node", "left")
        .select("page_id", "url", "host", "path", "rule", F.col("blocked").isNull().alias("allowed"))
    )
    return ruled.unionByName(rest_pages)
