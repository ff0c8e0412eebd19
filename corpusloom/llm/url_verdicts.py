"""URL verdicts: rules by host and path, spread over redirect-equivalent URLs.

A URL is judged by the longest rule that fits it. Redirects, canonical links and
fragments make URLs aliases of each other; the connected components of these
edges share a block: an alias of a blocked URL is blocked, unless a rule allows
it explicitly. Everything is DataFrame expressions, joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import connected_components
from corpusloom.session import cut_lineage

Rule = tuple[str, str]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Alias edges ``a, b`` that pages state: canonical links, refresh redirects, and each URL without its fragment.

    Links are resolved against the page's URL. Pages without a URL or link give no edge.
    """
    page, text = F.col(url), F.coalesce(F.col(html), F.lit(""))
    canonical = F.regexp_extract(text, r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    refresh = F.regexp_extract(
        text, r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*([^"'\s>]+)""", 1
    )
    origin = F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(page, r"(?s)^.*?://[^/?#]*((?:[^?#]*/)?)", 1)

    def resolved(link: Column) -> Column:
        link = F.replace(link, F.lit("&amp;"), F.lit("&"))
        return (
            F.when(link == "", None)
            .when(link.rlike("(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), link)
            .when(F.startswith(link, F.lit("//")), F.concat(F.regexp_extract(page, "(?s)^(.*?:)//", 1), link))
            .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), link))
        )

    targets = F.array(resolved(canonical), resolved(refresh), F.substring_index(page, "#", 1))
    edges = pages.where(page.isNotNull()).select(page.alias("a"), F.explode(F.array_distinct(targets)).alias("b"))
    return edges.where("b IS NOT NULL AND a <> b")


def judge_by_rules(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``url, rule, rule_verdict`` of the distinct URLs that a rule fits.

    ``rules`` has ``host, path, verdict``. A rule fits its host and all subdomains if
    the URL's path starts with the rule's; of several the longest holds, then an
    allowing one. URLs meet rules by an equi-join on each host suffix.
    """
    labels = F.split(F.col("host"), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    rules = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), F.col("verdict").alias("said"))
    met = urls.select("url", "path", F.explode(suffixes).alias("suffix")).join(rules, "suffix")
    text = F.concat("suffix", "start")
    best = F.max(F.struct(F.length(text), F.col("said") == "allow", text.alias("rule"), F.col("said").alias("rule_verdict")))
    fits = met.where(F.startswith("path", "start")).groupBy("url").agg(best.alias("best"))
    return fits.select("url", "best.rule", "best.rule_verdict")


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, links: DataFrame | None = None,
    key: str = "page_id", url: str = "url", html: str | None = "html",
) -> DataFrame:
    """Verdict on every page's URL: ``key, host, path, rule, verdict``.

    ``rules`` are (host, path, block or allow); ``links`` are further alias edges
    ``a, b`` such as a crawl's redirects. A fitting rule decides. Without one a URL
    is blocked if a member of its component is blocked by a rule, and allowed
    otherwise; allowing rules protect the URLs they fit and don't spread. A null
    URL, or one without ``://``, has an empty host and path, no alias and is
    allowed. Null keys and repeated rows stay; other columns take no part.

    URLs are judged once each, so repeated ones cost nothing more; components are
    a distributed loop, and the last join meets pages with two small columns a URL.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    edges = page_links(pages, url, html) if html else pages.select(F.col(url).alias("a")).where("false").withColumn("b", F.col("a"))
    if links is not None:
        edges = edges.union(links.select("a", "b"))
    edges = cut_lineage(edges)
    pages = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    urls = pages.select("url").union(edges.select("a")).union(edges.select("b")).where("url IS NOT NULL").distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = cut_lineage(judge_by_rules(urls, rules))
    members = connected_components(edges)
    blocked = members.join(judged.where("rule_verdict = 'block'"), F.col("node") == F.col("url"), "left_semi")
    hit = members.join(blocked.select("component").distinct(), "component", "left_semi").select(F.col("node").alias("url"))
    known = judged.join(hit.withColumn("hit", F.lit(True)), "url", "full")
    return pages.join(known, "url", "left").select(
        F.col("key").alias(key),
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("rule_verdict", F.when(F.col("hit"), "block").otherwise("allow")).alias("verdict"),
    )
