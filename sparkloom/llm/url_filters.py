"""URL filters with redirect equivalence, in DataFrame operations.

Rules name a host and a path prefix.  A url that no rule fits takes the decision
of its aliases: the urls joined to it by redirects and canonical links, found as
connected components over those edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.relational import spread_join
from ..session import materialize, repeatable
from ._util import quoted, table

#: The rules of op7, as (verdict, host, path).
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_CANONICAL = r"(?is)<link\s[^>]*rel\s*=\s*[\"']?canonical[^>]*>"
_REFRESH = r"(?is)<meta\s[^>]*http-equiv\s*=\s*[\"']?refresh[^>]*>"
_HREF = r"(?is)\shref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?is)url\s*=\s*[\"']?([^\"'\s>;]+)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def canonical_url(url: Column) -> Column:
    """The url with scheme and host in lower case and without its fragment."""
    site, whole = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_replace(url, r"(?s)#.*$", "")
    return F.concat(F.translate(site, _UPPER, _LOWER), F.substring(whole, F.length(site) + 1, F.length(whole)))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst): each page's url and the targets of all its canonical links and meta refreshes, made absolute."""
    html = quoted(html_col)
    canonical = F.transform(F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(0)), lambda tag: F.regexp_extract(tag, _HREF, 1))
    refresh = F.transform(F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(0)), lambda tag: F.regexp_extract(tag, _TARGET, 1))
    found = pages.select(quoted(url_col).alias("src"), F.explode(F.concat(canonical, refresh)).alias("to")).where("src is not null and to <> ''")
    to = F.replace(F.col("to"), F.lit("&amp;"), F.lit("&"))
    scheme, site = F.regexp_extract("src", r"(?s)^(.*?:)//", 1), F.regexp_extract("src", r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract("src", r"(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)", 1)
    full = F.when(to.contains("://"), to).when(to.startswith("//"), F.concat(scheme, to)).when(to.startswith("/"), F.concat(site, to)).otherwise(F.concat(F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/"))), to))
    return found.select("src", full.alias("dst"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, decision) of the distinct urls that a rule (verdict, host, path) fits.

    A rule fits its host and all subdomains if the url's path starts with the
    rule's; the rule of most characters wins, and of one text allow over block.
    Hosts are matched by their label suffixes, an equi-join whatever the number
    of rules; Spark broadcasts the rules if they are small.
    """
    parts = F.split(F.col("host"), r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    spread = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''").select("url", "path", F.explode(suffix).alias("host"))
    wanted = rules.select("host", F.col("path").alias("prefix"), F.col("verdict").alias("decision"))
    fits = spread.join(wanted, "host").where(F.col("path").startswith(F.col("prefix")))
    name = F.concat("host", "prefix")
    best = F.max(F.struct(F.length(name).alias("n"), (F.col("decision") == "allow").alias("allowed"), name.alias("rule"), F.col("decision").alias("decision")))
    return fits.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.decision")


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """pages with host, path, rule and verdict ('allow' or 'block').

    edges: (src, dst) of known redirects, besides those in the pages' html.  A
    url that a rule fits keeps that rule's verdict.  Any other is allowed if a rule
    allows one of its aliases, else blocked if a rule blocks one, else allowed.
    Urls are compared with scheme and host in lower case and without fragments.
    A null url or one without '://' has empty host and path, fits no rule and is
    allowed, but is followed as an alias if it is not null.  Null or empty html has no
    links, very long html is searched whole; repeated pages each get a row, and rules
    of one length and text that disagree allow.  No pages give no rows, no rules allow
    all.  Columns of pages with one of the new names are replaced.  The rows of a
    common url, and the urls of a large component, are spread over tasks; pages that are not
    repeatable() are written once.  keep: the columns to return, all if None.
    """
    pages = repeatable(pages)
    added = ("host", "path", "rule", "verdict")
    kept = [c for c in (pages.columns if keep is None else keep) if c.lower() not in added]
    links = link_edges(pages, url_col, html_col)
    if edges is not None:
        links = links.unionByName(edges.select("src", "dst"))
    parts = materialize(connected_components(links.select(canonical_url(F.col("src")).alias("src"), canonical_url(F.col("dst")).alias("dst"))))
    urls = pages.select(canonical_url(quoted(url_col)).alias("url")).where("url is not null").unionByName(parts.select(F.col("node").alias("url"))).distinct()
    ruled = match_rules(urls, rules)
    known = parts.withColumnRenamed("node", "url").join(ruled, "url")
    decided = known.groupBy("component").agg(F.min("decision").alias("shared"))  # allow sorts before block
    by_alias = spread_join(parts, decided, "component").select(F.col("node").alias("url"), "shared")
    verdicts = ruled.join(by_alias, "url", "full").select(F.col("url").alias("__url"), "rule", F.coalesce("decision", "shared").alias("found"))
    page = canonical_url(quoted(url_col)).alias("__url")
    frame = pages.select(F.struct(F.lit(True).alias("__sparkloom_row"), *(quoted(c) for c in kept)).alias("row"), quoted(url_col).alias("__page"), page)
    out = spread_join(frame, verdicts, "__url", "left", counted=pages.select(page))
    return out.select(*(F.col("row")[c].alias(c) for c in kept), host_of(F.col("__page")).alias("host"), path_of(F.col("__page")).alias("path"), "rule", F.coalesce("found", F.lit("allow")).alias("verdict"))


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def op7_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rules_table(spark, RULES), keep=["page_id"])


OP7_SQL = r"""
with recursive p as (
  select page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path, html
  from pages),
rules(verdict, h, pre) as (values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
e as (
  select url as src, replace(regexp_extract(regexp_extract(html, '(?is)<link\s[^>]*rel\s*=\s*["'']?canonical[^>]*>'), '(?is)\shref\s*=\s*["'']?([^"''\s>]+)', 1), '&amp;', '&') as dst from p
  union all select url, replace(regexp_extract(regexp_extract(html, '(?is)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh[^>]*>'), '(?is)url\s*=\s*["'']?([^"''\s>;]+)', 1), '&amp;', '&') from p),
b as (select src, dst from e where dst like '%://%' union select dst, src from e where dst like '%://%'),
reach as (select src as url, dst as other from b union select reach.url, b.dst from reach join b on reach.other = b.src),
nodes as (select distinct url from p where url is not null union select other from reach),
ruled as (
  select n.url, max({'n': length(h || pre), 'allowed': verdict = 'allow', 'rule': h || pre, 'verdict': verdict}) as best
  from (select url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path from nodes) n
  join rules on (n.host = h or n.host like '%.' || h) and starts_with(n.path, pre) group by n.url),
shared as (select reach.url, min(best.verdict) as verdict from reach join ruled on reach.other = ruled.url group by reach.url)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, shared.verdict, 'allow') as verdict
from p left join ruled on p.url = ruled.url left join shared on p.url = shared.url
"""
