"""URL filter with redirect equivalence (DataFrame functions only).

Rules name a host and a path prefix; they fit the host and its subdomains,
and the longest fitting rule decides.  URLs that redirect to each other or
name the same canonical URL are aliases: distributed connected components
over those edges form alias groups.  A URL without a rule of its own takes
its group's decision: allow if any member is explicitly allowed, else block
if any member is blocked, else allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower, table, written
from tidewatch.llm.components import connected_components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
         Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
         Rule("block", "com", "/de/"))
#: The rules are part of the plan, so their number is bounded.
MAX_RULES = 1000

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
LINK_TAG, META_TAG = r"(?is)<link\b[^>]*>", r"(?is)<meta\b[^>]*>"
IS_CANONICAL = r"""(?is)\brel\s*=\s*["']?\s*canonical\b"""
IS_REFRESH = r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b"""
HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)"""


def host_of(url: Column) -> Column:
    """Lower-cased host (with port) after the first ``://``; empty when there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; empty when there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule``, ``verdict`` of the longest rule that fits; an allow rule wins a tie."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    all_rules = F.array(*[F.struct(
        F.lit(len(r.host + r.path)).alias("length"), F.lit(int(r.verdict == "allow")).alias("allow"),
        F.lit(r.host + r.path).alias("rule"), F.lit(r.host).alias("host"),
        F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in rules])
    best = F.array_max(F.filter(all_rules, lambda r: (
        ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & F.startswith(path, r["path"]))))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"),
                                             best["verdict"].alias("verdict")))


def node_of(url: Column) -> Column:
    """The resource a URL names: without fragment, scheme and host lower-cased."""
    whole = r"(?s)^(.*?://)([^/?#]*)([^#]*).*$"
    return F.when(F.contains(url, F.lit("://")),
                  F.concat(ascii_lower(F.regexp_extract(url, whole, 1)), host_of(url),
                           F.regexp_extract(url, whole, 3)))


def resolved(base: Column, target: Column) -> Column:
    """Absolute URL of a link target on a page; null for what names no other page.

    Dot segments are kept as they stand.
    """
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(base))
    folder = F.coalesce(F.nullif(F.regexp_extract(path_of(base), r"(?s)^(.*/)", 1), F.lit("")),
                        F.lit("/"))
    t = F.replace(target, F.lit("&amp;"), F.lit("&"))
    return (F.when(t.isNull() | (t == "") | F.startswith(t, F.lit("#")), None)
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), t)
            .when(~F.contains(base, F.lit("://")), None)
            .when(F.startswith(t, F.lit("//")), F.concat(scheme, F.lit(":"), t))
            .when(F.startswith(t, F.lit("/")), F.concat(site, t))
            .when(F.startswith(t, F.lit("?")), F.concat(site, path_of(base), t))
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
            .otherwise(F.concat(site, folder, t)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """``a``, ``b``: nodes joined by a canonical link or a meta-refresh redirect of a
    page; every such tag of a page counts."""
    shown = pages.filter(F.col("html").rlike("(?i)canonical|http-equiv")).select(
        "url", F.explode(F.array(F.regexp_replace("html", HIDDEN, ""))).alias("html"))

    def named(tag: str, test: str, value: str) -> Column:
        """The targets of all matching tags of the page."""
        tags = F.filter(F.regexp_extract_all("html", F.lit(tag), F.lit(0)),
                        lambda x: x.rlike(test))
        return F.transform(tags, lambda x: F.regexp_extract(x, value, 1))

    targets = shown.select("url", F.explode(F.array_distinct(F.concat(
        named(LINK_TAG, IS_CANONICAL, HREF), named(META_TAG, IS_REFRESH, REFRESH_URL)))
    ).alias("target"))
    return targets.select(node_of(F.col("url")).alias("a"),
                          node_of(resolved(F.col("url"), F.col("target"))).alias("b")
                          ).filter("a is not null and b is not null and a <> b")


def judge(pages: DataFrame, rules=RULES, edges: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``by``.

    ``by`` tells what decided: rule, alias or default.  ``edges`` (``a``,
    ``b``: absolute URLs) adds alias edges known from elsewhere.

    * a null URL, or one without ``://``, has empty host and path, no alias
      and is allowed; null html has no links;
    * repeated rows each give a row; other columns are not read; an empty
      table gives no rows.
    """
    rows = pages.select("page_id", "url", "html")
    links = alias_edges(rows)
    if edges is not None:
        links = links.union(edges.select(node_of(F.col("a")), node_of(F.col("b"))))
    groups = connected_components(links)
    own = fitting_rule(host_of(F.col("node")), path_of(F.col("node")), rules)
    members = written(groups.select("node", "component", own["verdict"].alias("own")),
                      "alias-members")
    decided = written(
        members.groupBy("component").agg(
            F.when(F.max(F.col("own") == "allow"), "allow")
            .when(F.max(F.col("own") == "block"), "block").alias("group_verdict"))
        .filter("group_verdict is not null"), "alias-decisions")
    aliases = written(members.join(decided, "component").select("node", "group_verdict"),
                      "alias-verdicts")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    judged = rows.select("page_id", host.alias("host"), path.alias("path"),
                         fitting_rule(host, path, rules).alias("own"),
                         node_of(F.col("url")).alias("node"))
    verdict = F.coalesce("own.verdict", "group_verdict", F.lit("allow"))
    return judged.join(aliases, "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"), verdict.alias("verdict"),
        F.when(F.col("own").isNotNull(), "rule").when(F.col("group_verdict").isNotNull(), "alias")
        .otherwise("default").alias("by"))


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def oracle() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)

    def quoted(pattern: str) -> str:
        return "'" + pattern.replace("'", "''") + "'"

    def host(u: str) -> str:
        return (f"translate(regexp_extract({u}, '(?s)^.*?://([^/?#]*)', 1), "
                "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")

    def path(u: str) -> str:
        return f"regexp_extract({u}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"

    def node(u: str) -> str:
        return (f"CASE WHEN contains({u}, '://') THEN lower(regexp_extract({u}, '(?s)^(.*?://)', 1))"
                f" || {host(u)} || regexp_extract({u}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END")

    def named(tag: str, test: str, value: str) -> str:
        return (f"list_transform(list_filter(regexp_extract_all(h, {quoted(tag)}), "
                f"lambda x: regexp_matches(x, {quoted(test)})), "
                f"lambda x: regexp_extract(x, {quoted(value)}, 1))")

    absolute = "'^[A-Za-z][A-Za-z0-9+.\\-]*://'"
    site = f"regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || {host('url')}"
    return f"""
WITH RECURSIVE rules(verdict, rhost, rpath) AS (VALUES {rules}),
shown AS (SELECT url, regexp_replace(html, {quoted(HIDDEN)}, '', 'g') AS h FROM pages
          WHERE regexp_matches(html, '(?i)canonical|http-equiv')),
targets AS (
  SELECT url, replace(unnest(list_concat({named(LINK_TAG, IS_CANONICAL, HREF)},
                      {named(META_TAG, IS_REFRESH, REFRESH_URL)})), '&amp;', '&') AS t FROM shown),
full_targets AS (
  SELECT url, CASE
    WHEN t IS NULL OR t = '' OR starts_with(t, '#') THEN NULL
    WHEN regexp_matches(t, {absolute}) THEN t
    WHEN NOT contains(url, '://') THEN NULL
    WHEN starts_with(t, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || t
    WHEN starts_with(t, '/') THEN {site} || t
    WHEN starts_with(t, '?') THEN {site} || {path('url')} || t
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN NULL
    ELSE {site} || coalesce(nullif(regexp_extract({path('url')}, '(?s)^(.*/)', 1), ''), '/') || t
    END AS target FROM targets),
edges AS (SELECT {node('url')} AS a, {node('target')} AS b FROM full_targets),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION
                SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
urls AS (SELECT page_id, coalesce({host('url')}, '') AS host, coalesce({path('url')}, '') AS path,
                {node('url')} AS node FROM pages),
fits AS (
  SELECT host, path, arg_max(rhost || rpath, (len(rhost || rpath), verdict = 'allow')) AS rule,
         arg_max(verdict, (len(rhost || rpath), verdict = 'allow')) AS own
  FROM (SELECT host, path FROM urls UNION SELECT {host('b')}, {path('b')} FROM reach) u JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY host, path),
aliases AS (
  SELECT a AS node, CASE WHEN bool_or(own = 'allow') THEN 'allow'
                         WHEN bool_or(own = 'block') THEN 'block' END AS group_verdict
  FROM reach LEFT JOIN fits ON fits.host = {host('b')} AND fits.path = {path('b')} GROUP BY a)
SELECT page_id, host, path, rule, coalesce(own, group_verdict, 'allow') AS verdict,
       CASE WHEN own IS NOT NULL THEN 'rule' WHEN group_verdict IS NOT NULL THEN 'alias'
            ELSE 'default' END AS by
FROM urls LEFT JOIN fits USING (host, path) LEFT JOIN aliases USING (node)"""
