"""URL filters with redirect equivalence: aliases share a block decision, and an explicit allow comes first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.common import components, stored

# The rules of the check, (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*(/[^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as rows (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def _ancestors(host: Column) -> Column:
    """A host and its parent domains."""
    labels = F.split(host, "\\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _without_dots(path: Column) -> Column:
    """A path from ``/`` on, its segments ``.`` and ``..`` carried out."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    up = lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda a, s: F.when(s == "..", up(a)).when(s == ".", a).otherwise(F.concat(a, F.array(s))))
    folder = F.element_at(parts, -1).isin(".", "..")
    return F.concat(F.lit("/"), F.array_join(F.when(folder, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/"))


def resolve_url(base: Column, target: Column) -> Column:
    """A link's target as a full url, seen from the url ``base``; NULL if empty, of a scheme without ``//``, or relative to a base without ``://``."""
    site = F.regexp_extract(base, "(?s)^(.*?://[^/?#]*)", 1)
    path = url_path(base)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, "(?s)^(.*/)", 1))
    own = F.regexp_extract(target, "(?s)^([^?#]*)", 1)
    merged = _without_dots(F.when(own.startswith("/"), own).otherwise(F.concat(folder, own)))
    full = (
        F.when(target.startswith("//"), F.concat(F.regexp_extract(base, "(?s)^(.*?:)//", 1), target))
        .when(target.startswith("#"), F.concat(F.regexp_replace(base, "(?s)#.*$", ""), target))
        .when(target.startswith("?"), F.concat(site, path, target))
        .otherwise(F.concat(site, merged, F.regexp_extract(target, "(?s)^[^?#]*(.*)$", 1))))
    scheme = "(?i)^[a-z][a-z0-9+.-]*:"
    return F.when(target.rlike(scheme + "//"), target).when((target != "") & ~target.rlike(scheme) & (site != ""), full)


def alias_edges(pages: DataFrame) -> DataFrame:
    """(url, target) of canonical links and of redirects by refresh in the pages' markup, with full targets.

    Relative targets are resolved against the page's url, or its base element. Only tags are looked at; the markup of pages without such a tag is not searched further.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    some = html.rlike("(?i)<(link|meta)\\s[^>]*(canonical|refresh)")
    links = F.filter(F.regexp_extract_all(html, F.lit("(?i)<link\\s[^>]*>"), F.lit(0)), lambda t: t.rlike("(?i)\\brel\\s*=\\s*[\"']?canonical\\b"))
    metas = F.filter(F.regexp_extract_all(html, F.lit("(?i)<meta\\s[^>]*>"), F.lit(0)), lambda t: t.rlike("(?i)\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"))
    targets = F.concat(
        F.transform(links, lambda t: F.regexp_extract(t, "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)", 1)),
        F.transform(metas, lambda t: F.regexp_extract(t, "(?i)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)", 1)),
    )
    based = F.regexp_extract(html, "(?i)<base\\s[^>]*?\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)", 1)
    found = pages.where(some & F.col("url").isNotNull()).select("url", based.alias("based"), F.explode(targets).alias("target"))
    found = found.withColumn("based", F.coalesce(resolve_url(F.col("url"), F.col("based")), F.col("url")))
    found = found.select("url", resolve_url(F.col("based"), F.col("target")).alias("target"))
    return found.where(F.col("target") != F.col("url")).distinct()


def judge_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds host, path, rule and verdict to rows with a ``url``: the longest rule that fits, by host, then path.

    Rules meet a url by equality on one of its host's parent domains, so their number does not matter; each url is judged
    by one aggregate. A rule without a host fits nothing.
    """
    rules = stored(rules.select(F.col("verdict").alias("_v"), F.col("host").alias("_h"), F.col("path").alias("_p")).distinct(), "rules")
    parts = urls.select("url").distinct().withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    parts = stored(parts, "parts")
    tried = parts.select("url", "path", F.explode(_ancestors(F.col("host"))).alias("_h")).where("_h <> ''")
    fits = tried.join(rules, "_h").where(F.startswith("path", "_p"))
    # Longest host and path together; of equal lengths the longer path, then allow before block.
    best = F.max(F.struct((F.length("_h") + F.length("_p")).alias("n"), F.length("_p").alias("m"), (F.col("_v") == "allow").alias("a"), "_h", "_p", "_v"))
    judged = fits.groupBy("url").agg(best.alias("b")).select("url", F.concat("b._h", "b._p").alias("rule"), F.col("b._v").alias("verdict"))
    return parts.join(judged, "url", "left")


def filter_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(page_id, url, host, path, rule, alias_group, verdict), one row for each row of ``pages`` (page_id, url, html).

    A url with a fitting rule follows it: an explicit allow is never overruled. Without one, it is blocked if any alias is
    blocked by a rule and no alias is explicitly allowed; else it is allowed. Aliases are the connected components of
    canonical links and redirects, also through urls that are no page; ``edges`` (url, target) adds links known otherwise.
    ``alias_group`` is the smallest url of the component, NULL for a url without links.

    A NULL url has empty host and path, no rule and no aliases, and is allowed, as is one without ``://``. Repeated rows
    are each judged; an empty table gives no rows; an empty rule table blocks nothing. Other columns are ignored.
    """
    links = alias_edges(pages)
    if edges is not None:
        links = links.union(edges.select("url", "target").where("url IS NOT NULL AND target IS NOT NULL")).distinct()
    links = stored(links, "links")
    # A hundred million urls fit into memory as ids only, so nodes are numbered once in a stored table.
    nodes = links.select("url").union(links.select("target")).distinct()
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    every = pages.select("url").where("url IS NOT NULL").union(nodes.select("url"))
    judged = stored(judge_urls(every, rules), "judged")
    if nodes.count() == 0:
        groups = nodes.select("url", F.col("url").alias("alias_group"), F.lit(False).alias("inherits"))
    else:
        a, b = nodes.select(F.col("url").alias("url"), F.col("id").alias("a")), nodes.select(F.col("url").alias("target"), F.col("id").alias("b"))
        parts = components(links.join(a, "url").join(b, "target").select("a", "b"))
        member = nodes.join(parts, F.col("id") == F.col("node")).select("url", "component")
        said = member.join(judged.select("url", "verdict"), "url").groupBy("component").agg(
            F.min("url").alias("alias_group"),
            (F.max(F.coalesce(F.col("verdict") == "block", F.lit(False))) & ~F.max(F.coalesce(F.col("verdict") == "allow", F.lit(False)))).alias("inherits"))
        groups = stored(member.join(said, "component").select("url", "alias_group", "inherits"), "groups")
    verdict = F.coalesce(F.col("verdict"), F.when(F.coalesce("inherits", F.lit(False)), F.lit("block")).otherwise(F.lit("allow")))
    decided = judged.join(groups, "url", "left").select("url", "host", "path", "rule", "alias_group", verdict.alias("verdict"))
    empty = F.lit("")
    return pages.select("page_id", "url").join(decided, "url", "left").select(
        "page_id", "url", F.coalesce("host", empty).alias("host"), F.coalesce("path", empty).alias("path"), "rule", "alias_group",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )
