"""URL filter: rules by host and path, and block decisions that follow redirects and canonical links.

A page without a rule of its own takes the decision of its equivalence class. Classes
are the connected components of the graph whose nodes are urls (scheme and
fragment left out) and whose edges are ``<link rel=canonical>`` and
``<meta http-equiv=refresh>`` targets, found in the whole html. In a class an explicit allow
takes precedence over any block; without a rule anywhere the page is allowed.

Null or malformed urls have empty host and path and no class; null html has no
links; repeated rows are each judged; equal urls are one node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import Stage, ascii_lower, components, exact, table

#: (verdict, host, path); literal conditions, so a list of some hundreds at most.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)"
_LINK = r"""(?is)<link\b[^>]*?\brel\s*=\s*["']?\s*canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\b[^>]*?\bhttp-equiv\s*=\s*["']?\s*refresh\b[^>]*>"""
_HREF = r"""(?is)\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
_URL = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)"""


#: Markup in which no tag is one: comments, and elements whose content is plain text.
_NO_TAGS = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(rf"<{e}\b.*?(?:</{e}\s*>|\z)" for e in ("script", "style", "textarea", "title"))
#: Character references of the characters that mark up, in the order in which they are decoded.
REFERENCES = (
    ("&quot;", '"'), ("&#34;", '"'), ("&#x22;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#x27;", "'"), ("&lt;", "<"), ("&gt;", ">"),
    ("&#47;", "/"), ("&#x2F;", "/"), ("&#58;", ":"), ("&#x3A;", ":"), ("&#61;", "="), ("&#x3D;", "="), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"),
)


def _decoded(c: Column) -> Column:
    for reference, character in REFERENCES:
        c = F.replace(c, F.lit(reference), F.lit(character))
    return c


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """Host, path and query; null where the url has no host."""
    return F.when(host_of(url) != "", F.concat(host_of(url), path_of(url), F.regexp_extract(url, _PARTS, 3)))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    best = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, found) if best is None else best.when(fits, found)
    return best if best is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """The target of a link as an absolute url."""
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(target.contains("://"), target)
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(F.lit("x://"), host, target))
        .when(target.startswith("?"), F.concat(F.lit("x://"), host, path, target))
        .when(target != "", F.concat(F.lit("x://"), host, folder, target))
    )


def judge(spark: SparkSession, pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, component of every row of ``pages`` (page_id, url, html).

    A page's links are its first canonical link and its first refresh outside comments and plain-text elements,
    with the references of markup characters decoded.
    """
    stage = Stage(spark, "urls")
    host, path = F.col("host"), F.col("path")
    tags = F.regexp_replace("html", _NO_TAGS, "")
    link = _decoded(F.regexp_extract(F.regexp_extract(tags, _LINK, 0), _HREF, 1))
    refresh = F.regexp_extract(_decoded(F.regexp_extract(tags, _REFRESH, 0)), _URL, 1)
    read = exact(pages, "page_id", "url", "html").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), node_of(F.col("url")).alias("node"),
        F.when(F.col("html").rlike("(?i)<link\\b"), link).alias("link"), F.when(F.col("html").rlike("(?i)<meta\\b[^>]*refresh"), refresh).alias("refresh"),
    )
    slim = stage(
        read.select(
            "page_id", "host", "path", "node", matched_rule(host, path, rules).alias("own"),
            node_of(_resolved(F.col("link"), host, path)).alias("canonical"), node_of(_resolved(F.col("refresh"), host, path)).alias("redirect"),
        ),
        "pages",
    )
    ends = F.explode(F.array("canonical", "redirect"))
    classes = components(spark, slim.select(F.col("node").alias("a"), ends.alias("b")), "urls")
    # a node's own decision needs only its url, so targets that are no page count too
    url = F.concat(F.lit("x://"), F.col("id"))
    judged = classes.select("id", "component", matched_rule(host_of(url), path_of(url), rules)["verdict"].alias("v"))
    decided = judged.groupBy("component").agg(F.max(F.col("v") == "allow").alias("allowed"), F.max(F.col("v") == "block").alias("blocked"))
    by_node = classes.join(decided, "component").select(
        F.col("id").alias("node"), "component",
        F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow").alias("spread"),
    )
    return slim.join(by_node, "node", "left").select(
        "page_id", "host", "path", F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "spread", F.lit("allow")).alias("verdict"), F.coalesce("component", "node").alias("component"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark, table(spark, sf_dir, "pages"))


ORACLE = r"""
WITH RECURSIVE rules(verdict, h, q) AS (VALUES ('allow','com','/'),('block','example.com','/en/'),('allow','www.example.com','/en/'),('block','net','/es/'),('block','net','/fr/')),
p AS (
  SELECT page_id, html,
    translate(regexp_extract(coalesce(url,''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url,''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path,
    regexp_extract(coalesce(url,''), '^.*?://[^/?#]*[^?#]*(\??[^#]*)', 1, 's') AS query
  , regexp_replace(html, '<!--.*?(-->|\z)|<script\b.*?(</script\s*>|\z)|<style\b.*?(</style\s*>|\z)|<textarea\b.*?(</textarea\s*>|\z)|<title\b.*?(</title\s*>|\z)', '', 'gis') AS tags
  FROM pages),
t AS (
  SELECT *, CASE WHEN host <> '' THEN host || path || query END AS node,
    unnest([@D(regexp_extract(regexp_extract(tags, '<link\b[^>]*?\brel\s*=\s*["'']?\s*canonical\b[^>]*>', 0, 'is'), '\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is')),
            regexp_extract(@D(regexp_extract(tags, '<meta\b[^>]*?\bhttp-equiv\s*=\s*["'']?\s*refresh\b[^>]*>', 0, 'is')), '\burl\s*=\s*["'']?\s*([^"''\s>;]+)', 1, 'is')]) AS target
  FROM p),
u AS (
  SELECT node, CASE WHEN contains(target, '://') THEN target WHEN target LIKE '//%' THEN 'x:' || target
    WHEN target LIKE '/%' THEN 'x://' || host || target WHEN target LIKE '?%' THEN 'x://' || host || path || target
    WHEN target <> '' THEN 'x://' || host || coalesce(nullif(regexp_extract(path, '^(.*/)', 1, 's'), ''), '/') || target END AS target
  FROM t),
e AS (
  SELECT DISTINCT node AS a, lower(regexp_extract(target, '^.*?://([^/?#]*)', 1, 's')) || regexp_extract(target, '^.*?://[^/?#]*([^#]*)', 1, 's') AS b
  FROM u WHERE node IS NOT NULL AND regexp_extract(target, '^.*?://([^/?#]*)', 1, 's') <> ''),
g AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(id, c) AS (SELECT a, a FROM g UNION SELECT r.id, g.b FROM r JOIN g ON g.a = r.c),
comp AS (SELECT id, min(c) AS component FROM r GROUP BY id),
n AS (
  SELECT id, component, regexp_extract(id, '^[^/?#]*', 0) AS host, regexp_extract(id, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM comp),
nv AS (SELECT n.*, (SELECT arg_max(verdict, length(h || q)) FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, q)) AS v FROM n),
dec AS (SELECT component, CASE WHEN bool_or(v = 'allow') THEN 'allow' WHEN bool_or(v = 'block') THEN 'block' ELSE 'allow' END AS spread FROM nv GROUP BY 1),
own AS (
  SELECT p.*, CASE WHEN host <> '' THEN host || path || query END AS node,
    (SELECT arg_max(h || q, length(h || q)) FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, q)) AS rule,
    (SELECT arg_max(verdict, length(h || q)) FROM rules WHERE (host = h OR suffix(host, '.' || h)) AND prefix(path, q)) AS v
  FROM p)
SELECT page_id, host, path, rule, coalesce(v, spread, 'allow') AS verdict, coalesce(comp.component, node) AS component
FROM own LEFT JOIN comp ON comp.id = node LEFT JOIN dec ON dec.component = comp.component
"""


def _sql_decoded(sql: str) -> str:
    """``@D(..)`` written out; its argument holds no other ``@D`` and balanced brackets outside quotes."""
    head, mark, rest = sql.partition("@D(")
    if not mark:
        return sql
    depth, quoted, end = 1, False, 0
    while depth:
        quoted ^= rest[end] == "'"
        depth += 0 if quoted else {"(": 1, ")": -1}.get(rest[end], 0)
        end += 1
    out = rest[: end - 1]
    for reference, character in REFERENCES:
        literal = character.replace("'", "''")
        out = f"replace({out}, '{reference}', '{literal}')"
    return head + out + _sql_decoded(rest[end:])


ORACLE = _sql_decoded(ORACLE)
