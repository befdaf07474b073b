"""URL filter rules that follow redirects and canonical links.

A rule is a host, which also stands for its subdomains, and a path prefix; the longest fitting rule decides a url. Urls that
name one page by a redirect (meta refresh) or a canonical link are aliases: connected components over those links. A url that
no rule fits is blocked if a rule blocks one of its aliases and none is explicitly allowed; else it is allowed. A rule's own
verdict on a url always stands.

Every canonical link and every refresh of a page counts; ``canonical`` may be any word of the tag's rel. A tag ends at its first
``>``, and a tag's first href counts.

All work is joins and aggregates of columns. Rules meet hosts by an equality join on the host's suffixes.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule and has no aliases; null html has no
links; links to other schemes (``mailto:`` and the like) and empty ones are left out, as are tags without an href; long pages are read whole; dots in relative links are kept as they
are; repeated rows get the same verdict; of rules of one length the one that sorts first decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.llm.common import stored
from shelfwise.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^(.*?)://([^/?#]*)([^?#]*)([^#]*)"
LINK, META = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
CANONICAL = r"""(?is)[\s"'/]rel\s*=\s*(?:canonical\b|"([^">]*\s)?canonical(\s[^">]*)?"|'([^'>]*\s)?canonical(\s[^'>]*)?')"""
REFRESH = r"""(?is)[\s"'/]http-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)[\s"'/]href\s*=\s*["']?([^"'>\s]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'>\s]+)"""


def _part(url: Column, n: int) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, n), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 2), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 3)


def node_of(url: Column) -> Column:
    """The url without its fragment, scheme and host in lower case; null if it has no ``://``."""
    scheme = F.translate(_part(url, 1), UPPER, LOWER)
    return F.when(F.contains(url, F.lit("://")), F.concat(scheme, F.lit("://"), host_of(url), path_of(url), _part(url, 4)))


def resolved(base: Column, link: Column) -> Column:
    """The absolute url of a link on a page; null if it has none."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme, site = _part(base, 1), F.concat(_part(base, 1), F.lit("://"), host_of(base))
    folder = F.regexp_replace(path_of(base), "[^/]*$", "")
    return (F.when(F.length(link) == 0, None)
            .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
            .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
            .when(link.startswith("/"), F.concat(site, link))
            .when(link.startswith("?"), F.concat(site, path_of(base), link))
            .when(link.startswith("#"), base)
            .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), link)))


def _targets(html: Column, tag: str, kind: str, target: str) -> Column:
    """What every tag of a kind names; empty text for a tag that names nothing."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(tag), F.lit(0)), lambda t: t.rlike(kind))
    return F.transform(tags, lambda t: F.regexp_extract(t, target, 1))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page's node and the nodes of all its canonical links and refreshes, where they differ."""
    u, h = F.col(url), F.col(html)
    targets = F.concat(_targets(h, LINK, CANONICAL, HREF), _targets(h, META, REFRESH, REFRESH_URL))
    found = pages.where(h.rlike("(?i)canonical|refresh") & F.contains(u, F.lit("://"))).select(u.alias("url"), F.explode(targets).alias("t"))
    return found.select(node_of(F.col("url")).alias("a"), node_of(resolved(F.col("url"), F.col("t"))).alias("b")).where("a != b")


def with_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (distinct ``node``) with the longest fitting rule and its verdict, or nulls.

    ``rules``: host, path, verdict. A url meets only the rules of its own host's suffixes.
    """
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = urls.select("node", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    named = rules.select(F.col("host").alias("suffix"), F.col("path").alias("prefix"), "verdict")
    fits = parts.where("host != ''").select("node", "path", F.explode(suffixes).alias("suffix")).join(named, "suffix").where(
        "startswith(path, prefix)")
    text = F.concat("suffix", "prefix")
    best = fits.groupBy("node").agg(F.min(F.struct((-F.length(text)).alias("n"), text.alias("rule"), F.col("verdict"))).alias("r"))
    return urls.join(best, "node", "left").select("node", "r.rule", "r.verdict")


def judge(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page."""
    edges, _ = stored(page_links(pages, url, html).distinct(), "links")
    own = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), node_of(F.col(url)).alias("node"))
    nodes = own.select("node").unionByName(edges.select(F.col("b").alias("node"))).where("node IS NOT NULL").distinct()
    ruled, _ = stored(with_rule(nodes, rules), "ruled")
    roots = components(edges)
    placed = ruled.where("verdict IS NOT NULL").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "verdict")
    groups = placed.groupBy("root").agg(F.bool_or(F.col("verdict") == "allow").alias("some_allowed"))
    settled = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).join(groups, "root").select(
        "node", F.when(F.col("some_allowed"), "allow").otherwise("block").alias("group_verdict"))
    verdicts = ruled.join(settled, "node", "left").select(
        "node", "rule", F.coalesce("verdict", "group_verdict", F.lit("allow")).alias("verdict"))
    out = own.join(verdicts, "node", "left")
    return out.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "rule",
                      F.coalesce("verdict", F.lit("allow")).alias("verdict"))


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")
