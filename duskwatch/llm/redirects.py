"""Operator 6: url rules carried over redirects and canonical links.

Rules name a host (and all its subdomains) and a beginning of the path; the longest that fits decides. Pages that no rule fits take the
decision of their redirect equivalence class: pages are linked to what their canonical link or refresh points to (and by any redirect table given), components are formed over these links, and a component in which
a rule allows any address is allowed, else one in which a rule blocks any is blocked. What is left is allowed.

An address is its host, path without dot segments, and query; scheme and fragment make no other page. Links are read as a browser would:
comments, scripts and styles are no markup, entities are decoded, ``<base>`` counts. Defined cases: a null url, or one without "://", has empty
host and path, fits no rule and is no node; null html has no links; repeated pages are separate rows with one node; extra columns are
left out; empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.components import components
from duskwatch.llm.tables import settle

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host, slash, beginning of the path

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host):]


# The rules of the query.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))


def _rest(url: Column) -> Column:
    """What follows the first "://"; null if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _without_dots(path: Column) -> Column:
    """A path with its "." and ".." segments taken out; ".." at the top stays at the top."""
    given = F.split(F.substring(path, 2, F.length(path)), "/", -1)
    last = F.element_at(given, -1)
    steps = F.when(last.isin(".", ".."), F.concat(given, F.array(F.lit("")))).otherwise(given)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda acc, step: F.when(step == ".", acc).when(
        step == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(step))))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """Host, path without dot segments, and query: the address without scheme and fragment; null where there is no host."""
    path, query = path_of(url), F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path == "", F.lit("/")).otherwise(_without_dots(path)), query))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text of the longest rule that fits, else null. Of two as long, the one first in order of text."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.text)) if out is None else out.when(fits, F.lit(rule.text))
    return F.lit(None).cast("string") if out is None else out


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for r in rules:
        out = out.when(rule == r.text, F.lit(r.verdict))
    return out


# What is no markup of the page, though tags may be written in it; an unclosed one runs to the end.
_NO_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
# Entities with a name, besides &amp;.
_NAMED = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """Value of a tag's attribute, entities decoded; empty if there is none."""
    pattern = rf"""(?i)(?<![\w-]){name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return _let(F.btrim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)]), F.lit(" \t\r\n\f")), _decoded)


def _decoded(value: Column) -> Column:
    """Entities as their characters. An ampersand comes last, so that what it makes is not decoded once more."""
    def character(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "([0-9A-Fa-f]+);", 1)
        code = F.conv(digits, 10, 10).cast("bigint")
        code = F.when(F.lower(entity).startswith("&#x"), F.conv(digits, 16, 10).cast("bigint")).otherwise(code)
        sound = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        bits = F.unhex(F.lpad(F.hex(F.when(sound, code).otherwise(0xFFFD)), 8, "0"))
        return F.when(code == 38, F.lit("&amp;")).otherwise(F.decode(bits, "UTF-32"))

    numbers = F.array_distinct(F.regexp_extract_all(value, F.lit(r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"), F.lit(0)))
    out = F.aggregate(numbers, value, lambda acc, entity: F.replace(acc, entity, character(entity)))
    for entity, plain in _NAMED.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.when(F.contains(value, F.lit("&")), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(value)


def _resolved(to: Column, page: Column) -> Column:
    """The address ``to`` names on ``page``; dot segments are left to ``node_of``."""
    site = F.regexp_extract(page, "^[^/?#]*//[^/?#]*", 0)
    path = F.when(path_of(page) == "", F.lit("/")).otherwise(path_of(page))
    return (F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), to)
            .when(F.startswith(to, F.lit("//")), F.concat(F.regexp_extract(page, "^[^/?#]*:", 0), to))
            .when(F.startswith(to, F.lit("/")), F.concat(site, to))
            .when(F.startswith(to, F.lit("?")), F.concat(site, path, to))
            .when((to == "") | F.startswith(to, F.lit("#")), page)
            .otherwise(F.concat(site, F.regexp_extract(path, "^.*/", 0), to)))


def page_links(pages: DataFrame) -> DataFrame:
    """(src, dst) urls: canonical links and refreshes of ``pages`` (url, html), resolved against the page or its first ``<base>``.

    Comments, scripts and styles are no markup.
    """
    tags = F.regexp_extract_all(F.regexp_replace("html", _NO_MARKUP, " "), F.lit(r"(?i)<(?:link|meta|base)\b[^>]*>"), F.lit(0))
    found = pages.where("url is not null").where(F.col("html").rlike(r"(?i)\b(?:canonical|refresh)\b")).select("url", tags.alias("tags"))
    base = F.coalesce(F.get(F.filter("tags", lambda t: t.rlike(r"(?i)^<base\b") & (_attribute(t, "href") != "")), F.lit(0)), F.lit(""))
    rows = settle(found.select("url", base.alias("base"), F.explode("tags").alias("tag")), "tags")  # of few pages; each step below reads them
    tag = F.col("tag")
    canonical = tag.rlike("(?i)^<link") & F.array_contains(F.split(F.lower(_attribute(tag, "rel")), r"\s+"), "canonical")
    refresh = tag.rlike("(?i)^<meta") & (F.lower(_attribute(tag, "http-equiv")) == "refresh")
    to = (F.when(canonical, _attribute(tag, "href"))
          .when(refresh, F.regexp_extract(_attribute(tag, "content"), r"""(?i)\burl\s*=\s*["']?\s*([^"'\s]+)""", 1)))
    rows = settle(rows.select("url", _attribute(F.col("base"), "href").alias("base"), to.alias("to")), "targets").where("to != ''")
    dst = _let(_resolved(F.col("base"), F.col("url")), lambda page: _resolved(F.col("to"), page))
    return rows.select(F.col("url").alias("src"), dst.alias("dst"))


def class_verdicts(links: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(node, class_verdict) of every address that has a link, where a rule decides anything in its component."""
    links = settle(links, "links")  # the pages are searched once, and the addresses parsed from what was found
    ends = settle(links.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")).where("a != b").distinct(), "links")
    roots = components(ends, "a", "b")
    url = F.concat(F.lit("x://"), F.col("node"))  # a node is an address without its scheme
    ruled = roots.select("root", "node", host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = settle(ruled.select("root", "node", rule_of(F.col("host"), F.col("path"), rules).alias("rule")), "ruled")
    said = verdict_of(F.col("rule"), rules)
    per_class = ruled.groupBy("root").agg(F.max(said == "allow").alias("any_allow"), F.max(said == "block").alias("any_block"))
    verdict = F.when(F.col("any_allow"), F.lit("allow")).when(F.col("any_block"), F.lit("block"))
    return ruled.join(per_class, "root").select("node", verdict.alias("class_verdict")).where("class_verdict is not null")


def judge_pages(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict. ``redirects`` (src, dst) adds links known from elsewhere, such as a crawl's log."""
    plain = pages.select(F.col("page_id"), F.col("url").cast("string"), F.col("html").cast("string"))
    links = page_links(plain)
    if redirects is not None:
        links = links.unionAll(redirects.select(F.col("src").cast("string"), F.col("dst").cast("string")))
    classes = class_verdicts(links, rules)
    url = F.col("url")
    judged = plain.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("at"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    return judged.join(classes, F.col("at") == F.col("node"), "left").select(
        "page_id", "host", "path", "rule", F.coalesce(verdict_of(F.col("rule"), rules), "class_verdict", F.lit("allow")).alias("verdict"))
