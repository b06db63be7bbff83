"""URL filters with redirect equivalence, in DataFrame functions only.

Rules name a host and a path; the longest that fits decides.  Pages that no rule fits follow their
aliases: redirects and canonical links join urls into connected components, a block of any of them
spreads to all, and an explicit allow goes before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.llm.common import col, store_for
from cartwright.llm.components import connected_components
from cartwright.llm.exact_dedup import LOWER, UPPER

# (?is): any case, and dots match line ends.
# The word canonical may stand anywhere among those of rel.
_REL = r"""\brel\s*=\s*(?:"(?:[^">]*\s)?canonical(?=[\s"])|'(?:[^'>]*\s)?canonical(?=[\s'])|canonical(?=[\s/>]))"""
_CANONICAL = rf"""(?is)<link\b(?=[^>]*{_REL})[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*[\d.]*\s*[;,]\s*url\s*=\s*["']?([^"'\s>]+)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A to Z lowered, and path; both empty without ``://``."""
    has_scheme = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substring_index(F.substring_index(_after_scheme(url), "?", 1), "#", 1)
    host = F.substring_index(rest, "/", 1)
    path = F.substr(rest, F.char_length(host) + 1)
    return (
        F.when(has_scheme, F.translate(host, UPPER, LOWER)).otherwise(""),
        F.when(has_scheme, path).otherwise(""),
    )


def _after_scheme(url: Column) -> Column:
    return F.substr(url, F.instr(url, "://") + 3)


def node(url: Column) -> Column:
    """What two spellings of one address share: lower-case host, path and query."""
    host, path = host_and_path(url)
    bare = F.substring_index(_after_scheme(url), "#", 1)
    query = F.when(F.instr(bare, "?") > 0, F.substr(bare, F.instr(bare, "?"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, query))


def resolved(link: Column, base: Column) -> Column:
    """An absolute, host-relative or path-relative link as an absolute url."""
    scheme = F.substring_index(base, "://", 1)
    host, path = host_and_path(base)
    folder = F.when(F.instr(path, "/") > 0, F.regexp_replace(path, r"[^/]*$", "")).otherwise("/")
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    return (
        F.when(F.instr(link, "://") > 0, link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(scheme, F.lit("://"), host, link))
        .otherwise(F.concat(scheme, F.lit("://"), host, folder, link))
    )


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``a, b`` of every redirect and canonical link in the pages."""
    page = F.coalesce(col(html).cast("string"), F.lit(""))
    lowered = F.lower(page)
    none = F.array().cast("array<string>")
    targets = F.when(F.contains(lowered, F.lit("canonical")), F.regexp_extract_all(page, F.lit(_CANONICAL), F.lit(1))).otherwise(none)
    moved = F.when(F.contains(lowered, F.lit("refresh")), F.regexp_extract_all(page, F.lit(_REFRESH), F.lit(1))).otherwise(none)
    rows = pages.select(col(url).cast("string").alias("base"), F.concat(targets, moved).alias("links"))
    rows = rows.filter(F.exists("links", lambda link: link != "")).select("base", F.explode("links").alias("link")).filter("link <> ''")
    # Exploding one value keeps the optimizer from writing its expression out at every use.
    rows = rows.select("base", F.explode(F.array(resolved(F.col("link"), F.col("base")))).alias("target"))
    edges = rows.select(F.explode(F.array(node(F.col("base")))).alias("a"), "target").select("a", node(F.col("target")).alias("b"))
    return edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``rule_host, rule_path, rule_verdict`` of (host, path, allow or block)."""
    return spark.createDataFrame(rules, "rule_host string, rule_path string, rule_verdict string")


def match_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, rule_verdict`` of those places (host, path) that a rule fits.

    A place meets the rules of its host and all parent domains by an equality join.  Of rules of equal
    length an allow wins.
    """
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    distinct = places.filter("host <> ''").select("host", "path").distinct()
    met = distinct.withColumn("rule_host", F.explode(parents)).join(rules, "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    order = F.struct(
        (F.char_length("rule_host") + F.char_length("rule_path")).alias("length"),
        (F.col("rule_verdict") == "allow").alias("allows"),
        F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict",
    )
    best = met.groupBy("host", "path").agg(F.max(order).alias("best"))
    return best.select("host", "path", "best.rule", "best.rule_verdict")


def judge(
    pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", html: str = "html", edges: DataFrame | None = None
) -> DataFrame:
    """One row per page: ``<key>, host, path, rule, verdict``.

    ``verdict`` is the rule's.  Without a rule: allow if an alias is explicitly allowed, else block if an
    alias is blocked, else allow.  Aliases are reached over links in the pages and over ``edges``
    (a, b: urls).  Null urls and urls without ``://`` have an empty host and path, no aliases, and are
    allowed.  Null pages have no links; very long urls and pages are read whole.  Repeated rows are judged alike; an empty table gives an empty
    result; other columns are not read.
    """
    spark = pages.sparkSession
    store = store_for(pages)
    known = rule_table(spark, rules)
    links = link_edges(pages, url, html)
    if edges is not None:
        links = links.unionByName(edges.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")))
    aliases = connected_components(links, store, "aliases")
    alias_host = F.substring_index(F.substring_index("node", "?", 1), "/", 1)
    places = aliases.withColumn("host", alias_host)
    places = places.withColumn("path", F.substring_index(F.expr("substring(node, char_length(host) + 1)"), "?", 1))
    decided = places.join(match_rules(places, known), ["host", "path"])
    inherited = decided.groupBy("component").agg(F.max(F.col("rule_verdict") == "allow").alias("some_allow"))
    inherited = aliases.join(inherited, "component").select("node", F.when(F.col("some_allow"), "allow").otherwise("block").alias("inherited"))

    host, path = host_and_path(F.col("url"))
    rows = pages.select(col(key).alias("row_key"), col(url).cast("string").alias("url"))
    rows = rows.select("row_key", host.alias("host"), path.alias("path"), node(F.col("url")).alias("node"))
    rows = rows.join(match_rules(rows, known), ["host", "path"], "left").join(inherited, "node", "left")
    verdict = F.coalesce("rule_verdict", "inherited", F.lit("allow"))
    return rows.select(F.col("row_key").alias(key), "host", "path", "rule", verdict.alias("verdict"))
