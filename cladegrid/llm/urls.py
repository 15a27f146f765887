"""URL filters: explicit rules by host and path, and block decisions spread over redirect equivalence.

A rule (host, path, allow) fits its host and all subdomains where the url's path starts with the rule's; the longest
rule, host and path together, decides. Urls without a rule take a block from their aliases: pages joined by redirects
(meta refresh, or given link tables) and canonical links form components, found by distributed star contraction, and a
component with a blocked url is blocked. An explicit allow rule of a url keeps precedence; without any decision a url
is allowed.

Defined cases: a null url, or one without ``://``, has empty host and path; a null page is without links; repeated
pages are judged alike; only http and https targets are links, dot segments are removed, a base element is not followed; of equally long rules the block wins, then the smaller text; links to urls that are no pages
count; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cladegrid.llm.components import components

# after the first "://": host, path, query
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
LINK_TAGS = r"(?is)<(?:link|meta)\b[^>]*>"
# an attribute has a blank (or a quote) before its name
CANONICAL = r"(?is)[\s\"']rel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?is)[\s\"']http-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?is)[\s\"']href\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host (A-Z lower-cased), path, and what follows up to the fragment."""
    host, path, query = (F.coalesce(F.regexp_extract(url, URL, k), F.lit("")) for k in (1, 2, 3))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path, query


def node_of(url: Column) -> Column:
    """A url without scheme and fragment; null where it has no host."""
    host, path, query = split_url(url)
    return F.when(host != "", F.concat(host, path, query))


SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
ABSOLUTE = r"(?i)^https?://"


def without_dots(url: Column) -> Column:
    """The url with the segments ``.`` and ``..`` of its path taken out, the latter with the segment before them."""
    origin, path, rest = (F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$", k) for k in (1, 2, 3))
    segments = F.split(path, "/")

    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(segment == "..", shorter).when(segment == ".", done).otherwise(F.concat(done, F.array(segment)))

    kept = F.aggregate(F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"), step)
    ending = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    cleaned = F.concat(origin, F.lit("/"), F.array_join(F.concat(kept, ending), "/"), rest)
    return F.when(path.rlike(r"/\.\.?(/|$)"), cleaned).otherwise(url)


def resolve(base: Column, target: Column) -> Column:
    """A link target against the url of its page; null for a fragment and for schemes other than http and https."""
    scheme, host, path = F.regexp_extract(base, r"(?s)^(.*?)://", 1), F.regexp_extract(base, URL, 1), F.regexp_extract(base, URL, 2)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"^.*/", 0))
    return without_dots(
        F.when(target.rlike(ABSOLUTE), target)
        .when(target.rlike(SCHEME) | target.startswith("#"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(scheme, F.lit("://"), host, target))
        .when(target.startswith("?"), F.concat(scheme, F.lit("://"), host, path, target))
        .otherwise(F.concat(scheme, F.lit("://"), host, folder, target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(from_url, to_url): canonical links and meta refreshes in the head tags of whole pages."""
    chosen = pages.select(F.col(f"`{url}`").alias("from_url"), F.col(f"`{html}`").alias("html")).where(F.col("html").rlike(r"(?i)canonical|refresh"))
    tags = chosen.select("from_url", F.explode(F.regexp_extract_all("html", F.lit(LINK_TAGS), F.lit(0))).alias("tag"))
    target = F.when(F.col("tag").rlike(CANONICAL), F.regexp_extract("tag", HREF, 1)).when(F.col("tag").rlike(REFRESH), F.regexp_extract("tag", REFRESH_URL, 1))
    found = tags.select("from_url", F.replace(target, F.lit("&amp;"), F.lit("&")).alias("target")).where("target <> ''")
    return found.select("from_url", resolve(F.col("from_url"), F.col("target")).alias("to_url")).where("to_url is not null")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, allow) of the distinct (host, path) in ``urls`` that a rule (host, path, allow) fits.

    A url meets a rule by equality of one of its host's suffixes and of a path prefix of a length that the suffix's
    rules have, so a host with many rules or many urls is no product.
    """
    rules = rules.select(F.coalesce("host", F.lit("")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "allow").withColumn("length", F.length("rule_path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wide = urls.select("host", "path").distinct().withColumn("rule_host", F.explode(suffixes))
    lengths = rules.select("rule_host", "length").distinct()
    wide = wide.join(lengths, "rule_host").where(F.col("length") <= F.length("path"))
    met = wide.withColumn("rule_path", F.substr("path", F.lit(1), F.col("length"))).drop("length").join(rules.drop("length"), ["rule_host", "rule_path"])
    rule = F.concat("rule_host", "rule_path")
    best = F.min(F.struct((-F.length(rule)).alias("size"), F.col("allow").alias("allow"), rule.alias("rule"))).alias("best")
    return met.groupBy("host", "path").agg(best).select("host", "path", "best.rule", "best.allow")


def judge_pages(pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, url: str = "url", key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict) of every page; ``links`` are (from_url, to_url) of redirects and canonicals."""
    host, path, _ = split_url(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"), node_of(F.col(f"`{url}`")).alias("node"))
    decided = match_rules(rows, rules)
    joined = rows.join(decided, ["host", "path"], "left")
    blocked = None
    if links is not None:
        edges = links.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")).where("a is not null and b is not null")
        roots = components(edges)
        full = F.concat(F.lit("http://"), F.col("node"))
        node_host, node_path, _ = split_url(full)
        nodes = roots.withColumn("host", node_host).withColumn("path", node_path)
        hit = nodes.join(match_rules(nodes, rules).where("not allow"), ["host", "path"]).select("root").distinct()
        blocked = roots.join(hit, "root").select(F.col("node"), F.lit(True).alias("alias_blocked"))
        joined = joined.join(blocked, "node", "left")
    alias = F.coalesce("alias_blocked", F.lit(False)) if blocked is not None else F.lit(False)
    verdict = F.when(F.col("allow").isNotNull(), F.when(F.col("allow"), "allow").otherwise("block")).when(alias, "block").otherwise("allow")
    return joined.select("key", "host", "path", "rule", verdict.alias("verdict"))
