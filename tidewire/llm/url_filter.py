"""4. URL filter over redirect equivalence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewire.functions.text import unescape
from tidewire.functions.url import canonical_url, resolve_url
from tidewire.llm.common import lower_ascii, read, session
from tidewire.operators.graph import connected_components
from tidewire.plans.sqltext import canonical_url_sql
from tidewire.storage import Scratch

#: (verdict, rule); a rule is a host and a path that starts at its first slash.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))

#: A refresh after more seconds than this is a page's own matter.
REFRESH_SECONDS = 0
#: What no browser reads as markup: comments and the inside of scripts and styles.
HIDDEN = r"(?is)<!--.*?(?:-->|$)|<(script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|$)"
TAGS = r"(?is)<(?:link|meta)\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
ATTRIBUTE = r"(?s)([^\s\"'<>/=]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
#: Seconds, and a target in quotes or bare.
CONTENT = r"(?is)^\s*(\d+)[\d.]*\s*(?:[;,]\s*|\s)(?:url\s*=\s*)?(?:\"([^\"]*)\"?|'([^']*)'?|(.*))$"


def _tags(html: Column) -> Column:
    """The link and meta elements of a page as maps of their attributes, names in lower case; of an
    attribute that is repeated the first counts."""
    found = F.regexp_extract_all(F.regexp_replace(html, HIDDEN, " "), F.lit(TAGS), F.lit(0))

    def attributes(tag: Column) -> Column:
        inside = F.regexp_replace(tag, r"^<\w+", "")
        names = F.transform(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(1)), F.lower)
        values = F.transform(F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(2)), lambda v: F.regexp_replace(v, "^[\"']|[\"']$", ""))
        pairs = F.arrays_zip(names.alias("n"), values.alias("v"))
        return F.map_from_entries(F.filter(pairs, lambda p, i: F.array_position(names, p["n"]) == i + 1))

    return F.transform(found, attributes)


def links_of(html: Column) -> Column:
    """Where a page says that it is to be found: the targets of its canonical links and immediate
    refreshes, as they are written."""
    space = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")

    def target(tag: Column) -> Column:
        canonical = F.array_contains(F.split(F.lower(F.coalesce(tag["rel"], F.lit(""))), r"\s+"), "canonical")
        content = tag["content"]
        part = lambda i: F.regexp_extract(content, CONTENT, i)
        soon = (F.lower(space(tag["http-equiv"])) == "refresh") & (part(1).try_cast("long") <= REFRESH_SECONDS)
        return F.nullif(space(F.when(canonical, tag["href"]).when(soon, F.concat(part(2), part(3), part(4)))), F.lit(""))

    some = F.lower(html).rlike("canonical|refresh")
    return F.when(some, F.array_compact(F.transform(_tags(F.when(some, html)), target)))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """The longest rule that fits as (rule, verdict), or null: the host is the rule's or a subdomain
    of it, and the path starts with the rule's path. Of equally long rules, allow comes first."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def equivalences(pages: DataFrame, url: str = "url", html: str = "html", spellings: bool = False) -> DataFrame:
    """(src, dst): a page's URL with the targets of all its canonical links and of immediate
    refreshes (REFRESH_SECONDS). Attributes are read with double, single or no quotes and in any
    order, `rel` as a list of words; comments, scripts and styles are not read. Targets are unescaped
    and resolved against the page's URL. A target and a crawled URL that are spelt differently but
    have one canonical form meet in that form, a node of its own that no rule fits (see `form`).
    Crawled URLs that no link leads to are not joined by their spelling, unless `spellings` says so.

    Null URLs and pages without links give no edges; repeated rows repeat theirs; other columns are
    not read."""
    u = F.col(url)
    e = pages.where(u.isNotNull()).select(u.alias("src"), F.explode(links_of(F.col(html))).alias("dst"))
    e = e.withColumn("dst", resolve_url(unescape(F.col("dst")), F.col("src"))).where("contains(dst, '://')")
    e = Scratch(session(pages), "edges").table(e.where("dst <> src").distinct(), "links")
    targets = e.select("dst", form(F.col("dst")).alias("f"))
    crawled = pages.where(u.isNotNull()).select(u.alias("src"), form(u).alias("dst"))
    if not spellings:
        crawled = crawled.join(targets.select(F.col("f").alias("dst")).distinct(), "dst", "left_semi").select("src", "dst")
    return e.unionByName(crawled).unionByName(targets.select(F.col("dst").alias("src"), F.col("f").alias("dst")))


def form(url: Column) -> Column:
    """The node for all spellings of a URL: its canonical form, without the `://` that a URL has."""
    return F.replace(canonical_url(url), F.lit("://"), F.lit(" "))


def filter_urls(pages: DataFrame, edges: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict for each row of `pages`.

    A URL with a rule gets that rule's verdict, so an explicit allow beats whatever its aliases say.
    A URL without one is blocked if a rule blocks any URL of its component over `edges`, be it
    crawled or not, and is allowed otherwise. Components come from a distributed connected-components
    job; only the blocked URLs without a rule are joined back.

    A null URL, or one without `://`, has an empty host and path, no rule and the verdict allow.
    Rows that repeat a URL are each judged; null ends of edges are ignored; no rows give no rows.
    Other columns are not read.
    """
    scratch = Scratch(session(pages), "url-filter")
    component = connected_components(edges, "src", "dst", scratch)
    component = component.withColumn("r", rule_for(host_of(F.col("node")), path_of(F.col("node")), rules))
    component = scratch.table(component.select("node", "component", F.col("r.verdict").alias("v")), "components")
    blocked = component.where("v = 'block'").select("component").distinct()
    aliases = component.where("v is null").join(blocked, "component", "left_semi").select(F.col("node").alias("__url"), F.lit("block").alias("__alias"))
    host, path = host_of(F.col(url)), path_of(F.col(url))
    judged = pages.select(F.col(key).alias("__key"), F.col(url).alias("__url"), host.alias("host"), path.alias("path"))
    judged = judged.withColumn("r", rule_for(F.col("host"), F.col("path"), rules))
    return judged.join(aliases, "__url", "left").select(
        F.col("__key").alias(key), "host", "path", F.col("r.rule").alias("rule"), F.coalesce(F.col("r.verdict"), F.col("__alias"), F.lit("allow")).alias("verdict")
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return filter_urls(pages, equivalences(pages))


def _case(host: str, path: str, what: int) -> str:
    whens = "".join(
        f" WHEN ({host} = '{r[: r.index('/')]}' OR ends_with({host}, '.{r[: r.index('/')]}')) AND starts_with({path}, '{r[r.index('/') :]}') THEN '{(v, r)[what]}'"
        for v, r in sorted(RULES, key=lambda x: -len(x[1]))
    )
    return f"CASE{whens} END"


_HOST = "translate(regexp_extract(coalesce({u}, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce({u}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_FORM = "replace({u}, '://', ' ')"
#: Targets of links are absolute URLs here and hold no entities.
SQL = f"""
WITH RECURSIVE link AS (
  SELECT DISTINCT url AS src, dst FROM (
    SELECT url, coalesce(nullif(regexp_extract(html, '(?is)<link\\b[^>]*\\brel\\s*=\\s*["'']?canonical\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1), ''), regexp_extract(html, '(?is)<link\\b[^>]*\\bhref\\s*=\\s*["'']?([^"''\\s>]+)[^>]*\\brel\\s*=\\s*["'']?canonical\\b', 1)) AS dst FROM pages
    UNION ALL SELECT url, regexp_extract(html, '(?is)<meta\\b[^>]*http-equiv\\s*=\\s*["'']?refresh\\b[^>]*\\bcontent\\s*=\\s*["''][^"''>]*?url\\s*=\\s*([^"''>\\s]+)', 1) FROM pages)
  WHERE url IS NOT NULL AND dst <> url AND contains(dst, '://')),
target AS (SELECT DISTINCT dst AS src, {_FORM.format(u=canonical_url_sql("dst"))} AS dst FROM link),
edge AS (
  SELECT src, dst FROM link UNION SELECT src, dst FROM target
  UNION SELECT url, f FROM (SELECT url, {_FORM.format(u=canonical_url_sql("url"))} AS f FROM pages WHERE url IS NOT NULL) WHERE f IN (SELECT dst FROM target)),
und AS (SELECT src, dst FROM edge UNION SELECT dst, src FROM edge),
reach AS (SELECT src AS node, src AS other FROM und UNION SELECT reach.node, und.dst FROM reach JOIN und ON reach.other = und.src),
bad AS (SELECT DISTINCT node FROM reach WHERE {_case(_HOST.format(u="other"), _PATH.format(u="other"), 0)} = 'block'),
p AS (SELECT page_id, url, {_HOST.format(u="url")} AS host, {_PATH.format(u="url")} AS path FROM pages)
SELECT page_id, host, path, {_case("host", "path", 1)} AS rule,
  coalesce({_case("host", "path", 0)}, CASE WHEN node IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN bad ON bad.node = p.url
"""
