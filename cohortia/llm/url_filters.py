"""URL block rules that reach redirect and canonical aliases.

DataFrame functions only.  A rule (host, path, verdict) fits its host and all
subdomains when the path begins with the rule's; the longest one decides.  URLs
joined by redirects or canonical links form components; an URL without a rule
of its own is blocked when a rule blocks any URL of its component.  A rule on
the URL itself always decides, so an explicit allow is never overridden.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortia.llm.components import connected_components
from cohortia.llm.scratch import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Rules = list[tuple[str, str, str]]      # (host, path, "allow" | "block")


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Rules) -> Column:
    """The longest fitting rule as (rule, verdict); null if none fits."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def _absolute(link: Column, base: Column) -> Column:
    """``link`` as found on the page ``base``; null when it can't be resolved or leads to the page itself."""
    scheme = F.regexp_extract(base, r"^([^:/?#]+)://", 1)
    site = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"^([^:/?#]+://[^?#]*/)[^/?#]*", 1)
    return (F.when((link == "") | link.startswith("#"), None)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(site == "", None)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), link))
            .otherwise(F.concat(F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder), link)))


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` resolved in a path that begins with a slash."""
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda done, p: (
        F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(p == ".", done).otherwise(F.concat(done, F.array(p)))))
    end = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"), end)).otherwise(path)


def url_key(url: Column) -> Column:
    """An URL as a node: scheme and host in lower case (A-Z), an empty path as ``/``, dots
    resolved, without its fragment.  What has no ``://`` stays as it is, without its fragment."""
    part = lambda i: F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)([^?#]*)([^#]*)", i)
    path = F.when(part(2) == "", "/").otherwise(_without_dots(part(2)))
    return F.when(part(1) == "", F.regexp_extract(url, r"^([^#]*)", 1)).otherwise(
        F.concat(F.translate(part(1), UPPER, LOWER), path, part(3)))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Edges (a, b): page -> every canonical link (``rel`` may list more), page -> target of every refresh redirect."""
    html = F.coalesce(html_col, F.lit(""))

    def tags(pattern: str) -> Column:
        return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))

    rel = r"""(?is)\srel\s*=\s*("([^"]*\s)?canonical(\s[^"]*)?"|'([^']*\s)?canonical(\s[^']*)?'|canonical[\s/>])"""
    canonical = F.transform(F.filter(tags(r"(?is)<link\b[^>]*>"), lambda t: t.rlike(rel)),
                            lambda t: F.regexp_extract(t, r"""(?is)\shref\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    refresh = F.transform(F.filter(tags(r"(?is)<meta\b[^>]*>"), lambda t: t.rlike(r"""(?is)\shttp-equiv\s*=\s*["']?\s*refresh\b""")),
                          lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    found = pages.select(F.col(url_col).alias("a"), F.explode(F.concat(canonical, refresh)).alias("b")).where("b <> ''")
    return (found.select(url_key(F.col("a")).alias("a"),
                         url_key(_absolute(F.replace("b", F.lit("&amp;"), F.lit("&")), F.col("a"))).alias("b"))
            .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct())


def filter_urls(pages: DataFrame, rules: Rules, redirects: DataFrame | None = None,
                id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, host, path, rule, verdict, propagated (boolean).

    ``redirects`` (a, b) adds edges that the pages' html doesn't show.  ``rules`` is a list
    that fits into a plan (thousands).  A null URL, or one without ``://``, has
    an empty host and path, fits no rule and is allowed.  Repeated URLs share a node; equal
    rules on one host and path: block sorts last and wins.  Html of any length is searched whole;
    null or empty html has no links; other columns aren't read.  An empty table gives no rows.
    """
    edges = page_links(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(url_key(F.col("a")).alias("a"), url_key(F.col("b")).alias("b")))
    nodes = store(connected_components(edges), "aliases")
    verdict = rule_of(url_host(F.col("node")), url_path(F.col("node")), rules)["verdict"]
    bad = store(nodes.where(verdict == "block").select("component").distinct(), "blocked")
    bad_urls = store(nodes.join(bad, "component", "left_semi").select(F.col("node").alias("bad_url")).distinct(), "blocked-urls")
    host, path = url_host(F.col(url_col)), url_path(F.col(url_col))
    judged = pages.select(F.col(id_col), F.col(url_col), host.alias("host"), path.alias("path"),
                          url_key(F.col(url_col)).alias("key")) \
        .withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    judged = judged.join(bad_urls, F.col("key") == F.col("bad_url"), "left")
    propagated = F.col("r").isNull() & F.col("bad_url").isNotNull()
    return judged.select(
        id_col, url_col, "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.verdict"), F.when(propagated, "block").otherwise("allow")).alias("verdict"),
        propagated.alias("propagated"))
