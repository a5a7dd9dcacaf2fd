"""URL filter with redirect equivalence.

A url's own verdict is that of the longest rule that fits it. Urls tied by redirects or canonical
links are one resource under several names: the components of that graph carry a block decision to
every alias that no rule covers, and an explicit allow anywhere in the component outranks it.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import ascii_lower
from footfall.llm.components import NODE, TO, connected_components
from footfall.session import staged

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*(\?[^#]*)"
CANONICAL = r"""(?is)(<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>)"""
REFRESH = r"""(?is)(<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>)"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_TO = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
MAX_RULES = 2000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """A url's identity: host, path and query; scheme and fragment are not part of it. Null without host."""
    host = host_of(url)
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    return F.when(host != "", F.concat(host, path, F.regexp_extract(url, QUERY, 1)))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``struct<rule, verdict>`` of the longest fitting rule, allow before block at equal length; else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the expression holds {MAX_RULES} at most")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow", r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _absolute(target: Column, base: Column) -> Column:
    """A link's target as an absolute url; links relative to the page's folder are resolved too."""
    site = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    return (
        F.when(F.regexp_like(target, F.lit("^[A-Za-z][A-Za-z0-9+.-]*://")), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), target))
    )


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``from_url, to_url`` of canonical links and refresh redirects in the pages."""
    def targets(tag: str, attribute: str) -> Column:
        tags = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")), F.lit(tag), F.lit(1))
        return F.transform(tags, lambda t: F.regexp_extract(t, attribute, 1))

    found = F.concat(targets(CANONICAL, HREF), targets(REFRESH, REFRESH_TO))
    links = pages.select(F.col(url_col).alias("from_url"), F.explode(found).alias("target")).where("target <> ''")
    return links.select("from_url", _absolute(F.col("target"), F.col("from_url")).alias("to_url"))


def _component_verdicts(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``node, alias_verdict`` of every linked url whose component holds a rule's verdict."""
    ends = links.select(
        *(F.struct(node_of(F.col(c)).alias("node"), host_of(F.col(c)).alias("host"), path_of(F.col(c)).alias("path")).alias(c)
          for c in ("from_url", "to_url"))
    ).where("from_url.node is not null and to_url.node is not null")
    edges = staged(ends.distinct(), "links")
    members = connected_components(
        edges.select(F.col("from_url.node").alias("a"), F.col("to_url.node").alias("b")), "a", "b"
    )
    nodes = edges.select("from_url.*").unionByName(edges.select("to_url.*"))
    # "/" and "" are one node but not one path: a node is allowed or blocked if any of its forms is
    judged = nodes.groupBy("node").agg(
        F.max(F.coalesce(matching_rule(F.col("host"), F.col("path"), rules)["verdict"] == "allow", F.lit(False))).alias("allow"),
        F.max(F.coalesce(matching_rule(F.col("host"), F.col("path"), rules)["verdict"] == "block", F.lit(False))).alias("block"),
    )
    placed = judged.withColumnRenamed("node", NODE).join(members, NODE)
    verdicts = placed.groupBy(TO).agg(F.max("allow").alias("allow"), F.max("block").alias("block")).where("allow or block")
    return members.join(verdicts, TO).select(
        F.col(NODE).alias("node"), F.when(F.col("allow"), "allow").otherwise("block").alias("alias_verdict")
    )


def judge_pages(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None,
    url_col: str = "url", html_col: str = "html",
) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` (they replace columns of those names).

    The verdict is the longest rule's; without one, the component's (allow if any member is
    explicitly allowed, else block if any is blocked); else allow. Null urls, and urls without
    ``://``, have empty host and path, no links, and are allowed. Repeated pages are judged alike.
    ``redirects`` may add links (``from_url, to_url``) known from a crawl; null html has no links.
    """
    links = page_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("from_url", "to_url"))
    verdicts = _component_verdicts(links, rules)
    kept = pages.drop("host", "path", "rule", "verdict")
    own = matching_rule(F.col("host"), F.col("path"), rules)
    judged = kept.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    judged = judged.withColumn("__own", own).withColumn("__node", node_of(F.col(url_col)))
    aliases = verdicts.select(F.col("node").alias("__node"), F.col("alias_verdict").alias("__alias"))
    return (
        judged.join(aliases, "__node", "left")
        .withColumn("rule", F.col("__own.rule"))
        .withColumn("verdict", F.coalesce(F.col("__own.verdict"), F.col("__alias"), F.lit("allow")))
        .drop("__own", "__node", "__alias")
    )
