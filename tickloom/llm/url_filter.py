"""URL filters that hold for all aliases of a page (redirects and canonical links)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import ascii_lower, store
from tickloom.llm.components import components

# (action, host, path); a rule fits its host and all subdomains.
Rule = tuple[str, str, str]

# The rules that the query applies.
RULES: tuple[Rule, ...] = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
# A tag ends before the next "<", so that broken markup costs one look per character.
_TAG = r"(?i)<(?:link|meta)\s[^<>]*+>"
_TARGET = {
    "link": (r"(?i)\srel\s*=\s*[\"']?\s*canonical\b", r"(?i)\shref\s*=\s*[\"']?\s*([^\"'\s>]+)"),
    "meta": (r"(?i)\shttp-equiv\s*=\s*[\"']?\s*refresh\b", r"(?i)[;\s\"']url\s*=\s*[\"']?\s*([^\"'\s>]+)"),
}


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased; else ''."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?`` or ``#``; else ''."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def url_key(url: Column) -> Column:
    """What makes two URLs the same node: host, path and query. Null without a host."""
    host = url_host(url)
    query = F.regexp_extract(url, _PARTS, 3)
    return F.when(host != "", F.concat(host, url_path(url), query))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits as ``struct(rule, action)``; null if none does.

    Of rules of one length an allowing one wins, then the smaller text.
    """
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1] + r[2]))
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in reversed(ranked):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))
        found = F.when(fits, named).otherwise(found)
    return found


def page_links(pages: DataFrame) -> DataFrame:
    """``(from_url, to_url)`` of the canonical links and refreshing redirects in ``html``.

    Targets may be absolute, start with ``//`` or ``/``, or lie beside the page.
    """
    tags = pages.where("url is not null").select(
        "url", F.explode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(0))).alias("tag")
    )
    target = F.lit(None).cast("string")
    for name, (wanted, value) in _TARGET.items():
        is_this = F.lower(F.substring("tag", 2, 4)) == name
        target = F.when(is_this & F.col("tag").rlike(wanted), F.regexp_extract("tag", value, 1)).otherwise(target)
    scheme, host = F.regexp_extract("url", r"(?s)^(.*?://)", 1), F.regexp_extract("url", _PARTS, 1)
    folder = F.regexp_replace(url_path(F.col("url")), r"[^/]*$", "")
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    to_url = (
        F.when(F.col("target").contains("://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(F.regexp_replace(scheme, "//$", ""), "target"))
        .when(F.col("target").startswith("/"), F.concat(scheme, host, "target"))
        .otherwise(F.concat(scheme, host, folder, "target"))
    )
    return (
        tags.select("url", target.alias("target")).where("target is not null and target <> ''")
        .select(F.col("url").alias("from_url"), to_url.alias("to_url"))
    )


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """``(page_id, url, host, path, rule, verdict)``, one row per page row.

    ``pages`` has ``page_id, url, html``; ``redirects``, if given, has ``from_url, to_url``.
    A page's own rule decides. Any other page takes the decision of the URLs that redirects
    and canonical links connect it with, pages or not: allow if any of them is allowed by a
    rule, else block if any is blocked, else allow. A null url, or one without ``://``, has
    empty host and path, fits no rule and has no alias. Null html has no links. Repeated
    pages are judged each; other columns of the input are left out. No page, no row.

    Aliases are the connected components of the links, found by distributed star
    contraction. Only pages without a rule meet them, by an equi-join on the URL.
    """
    pages = pages.select("page_id", "url", "html")
    links = page_links(pages)
    if redirects is not None:
        links = links.union(redirects.select("from_url", "to_url"))
    links = store(links, "url-links")
    edges = links.select(url_key(F.col("from_url")).alias("a"), url_key(F.col("to_url")).alias("b"))
    groups = components(store(edges, "url-edges"))

    # A key is host + path + query, so it can be judged as if a scheme stood before it.
    as_url = F.concat(F.lit("://"), F.col("node"))
    action = fitting_rule(url_host(as_url), url_path(as_url), rules)["action"]
    decided = groups.select("node", "component", action.alias("action"))
    by_group = decided.groupBy("component").agg(F.min("action").alias("inherited"))  # allow < block
    aliases = (
        groups.join(by_group.where("inherited = 'block'"), "component")
        .select(F.col("node").alias("alias_key"), "inherited")
    )

    judged = pages.select(
        "page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"),
        url_key(F.col("url")).alias("key"),
    ).withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    # Pages with a rule need no alias: their key is null here, and null meets nothing.
    open_key = F.when(F.col("found").isNull(), F.col("key"))
    return judged.withColumn("open_key", open_key).join(
        aliases, F.col("open_key") == F.col("alias_key"), "left"
    ).select(
        "page_id", "url", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.action", "inherited", F.lit("allow")).alias("verdict"),
    )
