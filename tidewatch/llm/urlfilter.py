"""Operator 5: URL filter with redirect equivalence, in DataFrame operations.

Each url is judged by the longest rule that fits: a rule fits its host and all
subdomains if the url's path starts with the rule's path. Urls that no rule fits
are judged by their aliases. Pages name aliases in canonical links and in
refresh redirects, every such tag counts and relative targets are resolved
against the page (RFC 3986); further redirects may be given as a table. The connected
components of these edges are the aliases: an explicit allow of one member
allows the others, else an explicit block of one blocks them, else they are
allowed. A url with a rule of its own keeps that rule's verdict.

The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z
lower-cased; the path what follows up to `?`, `#` or the end. A null url, or one
without `://`, has an empty host and path, no rule and no alias. Repeated pages
are judged each. Fragments don't distinguish nodes. Only page_id, url and html
are read, so other columns may have any name; html may be missing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import common


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return common.ascii_lower(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"(?s)^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, else null."""
    out = None
    for r in sorted(rules, key=lambda r: -len(r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def node(url: Column) -> Column:
    """The url less its fragment and dot segments, with scheme and host lower-cased."""
    bare = F.regexp_extract(url, r"(?s)^([^#]*)", 1)
    at = F.locate("://", bare)
    head = F.length(host_of(bare)) + at + 2
    path = path_of(bare)
    rest = F.concat(undotted(path), F.substr(bare, head + F.length(path) + 1))
    return F.when(at > 0, F.concat(common.ascii_lower(F.substr(bare, F.lit(1), head)), rest))


def aliases(pages: DataFrame) -> DataFrame:
    """(src, dst) nodes of canonical links and refresh redirects in the html."""
    low = F.lower("html")
    named = pages.where(F.col("url").contains("://") & (low.contains("canonical") | low.contains("refresh")))
    link = F.expr(r"""regexp_extract_all(html, '(?is)<link\\b([^>]*\\brel\\s*=\\s*["\']?canonical\\b[^>]*)>', 1)""")
    meta = F.expr(r"""regexp_extract_all(html, '(?is)<meta\\b([^>]*\\bhttp-equiv\\s*=\\s*["\']?refresh\\b[^>]*)>', 1)""")
    href = lambda tag: F.regexp_extract(tag, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    goal = lambda tag: F.regexp_extract(tag, r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""", 1)
    tags = F.concat(F.transform(link, href), F.transform(meta, goal))
    found = named.select("url", F.explode(tags).alias("to")).where("to <> ''")
    to = F.replace(F.col("to"), F.lit("&amp;"), F.lit("&"))
    whole = resolve(F.col("url"), to)
    return found.select(node(F.col("url")).alias("src"), node(whole).alias("dst")).where("dst IS NOT NULL AND src <> dst")


def undotted(path: Column) -> Column:
    """The path without dot segments (RFC 3986, 5.2.4)."""
    parts = F.split(path, "/")
    step = lambda done, x: (
        F.when(x == ".", done).when(x == "..", F.when(F.size(done) > 1, F.slice(done, 1, F.size(done) - 1)).otherwise(done)).otherwise(F.concat(done, F.array(x)))
    )
    kept = F.aggregate(parts, F.array().cast("array<string>"), step)
    end = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(path.contains("/."), F.concat(F.array_join(kept, "/"), end)).otherwise(path)


def resolve(url: Column, to: Column) -> Column:
    """The reference `to` on a page of this url (RFC 3986, 5.2); null for other
    schemes, as mailto: or javascript:."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    query = F.regexp_extract(url, r"(?s)^[^#?]*(\?[^#]*)", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    own = F.regexp_extract(to, r"(?s)^([^?#]*)", 1)
    rest = F.substr(to, F.length(own) + 1)
    full = to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    there = F.when(full, to).when(to.startswith("//"), F.concat(scheme, F.lit(":"), to))
    head = F.regexp_extract(there, r"(?s)^([^:]*://[^/?#]*)", 1)
    tail = F.substr(there, F.length(head) + F.length(path_of(there)) + 1)
    return (
        F.when(there.isNotNull(), F.concat(head, undotted(path_of(there)), tail))
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(to.startswith("/"), F.concat(root, undotted(own), rest))
        .when(to.startswith("?"), F.concat(root, path, to))
        .when(to.startswith("#"), F.concat(root, path, query, to))
        .otherwise(F.concat(root, undotted(F.concat(folder, own)), rest))
    )


def judge(
    pages: DataFrame, rules: Sequence[Rule] = RULES, *, redirects: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. redirects: url, target."""
    edges = None
    if "html" in pages.columns:
        edges = aliases(pages)
    if redirects is not None:
        more = redirects.select(node(F.col("url")).alias("src"), node(F.col("target")).alias("dst"))
        edges = more if edges is None else edges.unionByName(more)
    own = rule_of(F.col("host"), F.col("path"), rules)
    out = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    out = out.withColumn("own", own)
    if edges is not None:
        edges = common.settle(edges.where("src IS NOT NULL AND dst IS NOT NULL").distinct(), "aliases")
        if edges.isEmpty():
            edges = None
    if edges is not None:
        groups = common.connected_components(edges)
        judged = groups.select("node", "component", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
        judged = common.settle(judged.select("node", "component", own["verdict"].alias("v")), "alias-nodes")
        by_group = judged.groupBy("component").agg(
            F.max(F.when(F.col("v") == "allow", 2).when(F.col("v") == "block", 1).otherwise(0)).alias("most")
        )
        told = judged.join(by_group, "component").select(
            "node", F.when(F.col("most") == 2, "allow").when(F.col("most") == 1, "block").alias("by_alias")
        )
        out = out.withColumn("node", node(F.col("url"))).join(told, "node", "left")
    else:
        out = out.withColumn("by_alias", F.lit(None).cast("string"))
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "by_alias", F.lit(default)).alias("verdict"),
    )


def op5_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))


#: Aliases by absolute urls and by paths from the root; the tables name none, and
#: relative ones are tested against the standard library.
OP5_SQL = r"""
WITH RECURSIVE r AS (
  SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), tags AS (
  SELECT url, unnest(list_concat(
    list_transform(regexp_extract_all(html, '(?is)<link\b([^>]*\brel\s*=\s*["'']?canonical\b[^>]*)>', 1),
      lambda t: regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(regexp_extract_all(html, '(?is)<meta\b([^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*)>', 1),
      lambda t: regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)))) AS target
  FROM pages WHERE strpos(url, '://') > 0
), links AS (
  SELECT url AS a, CASE WHEN strpos(target, '://') > 0 THEN target WHEN starts_with(target, '/')
    THEN regexp_extract(url, '^(.*?://[^/?#]*)', 1) || target END AS b FROM tags
), ends AS (
  SELECT a, b FROM links WHERE b IS NOT NULL AND b <> ''
), nodes AS (
  SELECT *, regexp_extract(u, '^([^#]*)', 1) AS bare FROM (SELECT a AS u FROM ends UNION SELECT b FROM ends UNION SELECT url FROM pages WHERE strpos(url, '://') > 0)
), named AS (
  SELECT u, lower(regexp_extract(bare, '^(.*?://[^/?#]*)', 1)) || regexp_replace(bare, '^.*?://[^/?#]*', '') AS node FROM nodes
), edges AS (
  SELECT x.node AS a, y.node AS b FROM ends JOIN named x ON ends.a = x.u JOIN named y ON ends.b = y.u WHERE x.node <> y.node
), both_ways AS (
  SELECT a, b FROM edges UNION SELECT b, a FROM edges
), reach AS (
  SELECT a AS node, a AS other FROM both_ways UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON reach.other = both_ways.a
), all_hosts AS (
  SELECT false AS page, CAST(NULL AS BIGINT) AS page_id, node AS url, regexp_extract(substr(node, strpos(node, '://') + 3), '^([^/?#]*)', 1) AS host,
    regexp_extract(substr(node, strpos(node, '://') + 3), '^[^/?#]*([^?#]*)', 1) AS path FROM (SELECT DISTINCT other AS node FROM reach)
  UNION ALL SELECT true, page_id, url, host, path FROM h
), j AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM all_hosts
), v AS (
  SELECT *, CASE WHEN rule IS NULL THEN 0 WHEN rule IN ('example.com/de/', 'net/') THEN 1 ELSE 2 END AS told FROM j
), by_alias AS (
  SELECT reach.node, max(told) AS told FROM reach JOIN v ON v.url = reach.other AND NOT v.page GROUP BY reach.node
)
SELECT v.page_id, v.host, v.path, v.rule,
  CASE WHEN v.told = 1 OR v.told = 0 AND by_alias.told = 1 THEN 'block' ELSE 'allow' END AS verdict
FROM v LEFT JOIN (SELECT DISTINCT u, node FROM named) n ON n.u = v.url LEFT JOIN by_alias ON by_alias.node = n.node
WHERE v.page
"""
