"""URL decisions: rules by host and path, propagated to aliases over redirect and canonical-link edges.

A page without a rule of its own takes the decision of its alias group: the connected component of its address over
the redirects and canonical links that the pages declare. One explicitly allowed address in a group allows its
undecided aliases, else one explicitly blocked address blocks them, else they are allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import connected_components
from barloom.llm.scratch import Scratch

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Character references that addresses in HTML are written with; the ampersand's own come last. Fixed values.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&"))
#: Parts of a query string that do not change what an address shows.
TRACKING = r"^(utm_[a-z]+|gclid|fbclid|ref|sessionid)="


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to a slash, question mark, number sign or the end; A-Z lower-cased. Null:
    empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def plain_path(path: Column) -> Column:
    """A path without the segments ``.`` and ``..``; the latter take the one before away, if there is one."""
    closed = F.regexp_replace(path, r"/(\.\.?)\z", "/$1/")
    segments = F.filter(F.split(closed, "/"), lambda _, i: i > 0)
    merged = F.aggregate(
        segments,
        F.lit(""),
        lambda done, s: F.when(s == ".", done).when(s == "..", F.regexp_replace(done, r"/[^/]*\z", "")).otherwise(F.concat(done, F.lit("/"), s)),
    )
    return F.when(path.rlike(r"/\.\.?(/|\z)"), merged).otherwise(path)


def rule_for(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does; of equally long ones an allowing rule
    wins."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow")):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def address(url: Column) -> Column:
    """One name for spellings of an address: no scheme, fragment, dot segments, tracking parameters or closing slash.
    Null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^[^#]*?\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda part: (part != "") & ~part.rlike(TRACKING)), "&")
    return F.when(
        F.instr(url, "://") > 0,
        F.concat(host_of(url), F.rtrim(plain_path(path_of(url)), F.lit("/")), F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")),
    )


def _unescaped(text: Column) -> Column:
    for reference, character in REFERENCES:
        text = F.replace(text, F.lit(reference), F.lit(character))
    return text


def declared_targets(html: Column) -> Column:
    """The addresses that a page gives as its canonical one (a token of ``rel``) or redirects to, character references
    replaced."""
    attribute = r"""(?i)\b{}\s*=\s*["']?([^"'\s>]++)"""
    token = r"""(?i)\brel\s*=\s*(?:"(?:[^"]*\s)?canonical(?:\s[^"]*)?"|'(?:[^']*\s)?canonical(?:\s[^']*)?'|canonical[\s/>])"""
    links = F.filter(F.regexp_extract_all(html, F.lit(r"(?i)<link\b[^>]*+>"), 0), lambda tag: tag.rlike(token))
    metas = F.filter(
        F.regexp_extract_all(html, F.lit(r"(?i)<meta\b[^>]*+>"), 0), lambda tag: tag.rlike(r"""(?i)\bhttp-equiv\s*=\s*["']?refresh\b""")
    )
    return F.filter(
        F.concat(
            F.transform(links, lambda tag: _unescaped(F.regexp_extract(tag, attribute.format("href"), 1))),
            F.transform(metas, lambda tag: _unescaped(F.regexp_extract(tag, r"""(?i)\burl\s*=\s*'?([^"'\s>]++)""", 1))),
        ),
        lambda target: target != "",
    )


def absolute(target: Column, url: Column) -> Column:
    """A target beside the address that names it: whole, from the scheme on, from the host on, another query of the same
    path, another place of the same page, or from the folder on; without dot segments. Null for schemes without a host,
    such as ``mailto:``."""
    origin, path = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), path_of(url)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    whole = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(origin, path, target))
        .when(target.startswith("#"), url)
        .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )
    rest = F.regexp_extract(whole, r"(?s)^.*?://[^?#]*(.*)\z", 1)
    return F.when(
        whole.isNotNull(), F.concat(F.regexp_extract(whole, r"(?s)^(.*?://[^/?#]*)", 1), plain_path(path_of(whole)), rest)
    )


def judge_pages(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule, verdict, address, alias_of.

    Null urls and urls without ``://`` have an empty host and path, no address and no aliases; they are allowed. Null
    html declares nothing. Repeated rows are judged alike. A target that is no page has no verdict of its own unless a
    rule fits it; then it counts in its group like a page. Other columns are ignored, an empty table gives an empty one.
    Pages of any length are searched whole. ``alias_of`` is the smallest address of the group.
    """
    scratch = Scratch(pages.sparkSession)
    url = F.col("url").cast("string")
    edges = scratch.store(
        pages.where(F.instr("url", "://") > 0)
        .select(url.alias("url"), F.explode(F.array_distinct(declared_targets(F.col("html").cast("string")))).alias("target"))
        .select("url", absolute(F.col("target"), F.col("url")).alias("target"))
        .select(address(F.col("url")).alias("a"), "url", address(F.col("target")).alias("b"), "target")
        .where("b IS NOT NULL")
    )
    groups = scratch.store(connected_components(edges.select("a", "b"), scratch))
    named = pages.select("page_id", url.alias("url")).select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), address(F.col("url")).alias("address"))
    ruled = named.withColumn("own", rule_for(F.col("host"), F.col("path"), rules))
    # What rules say of every address of a group, pages and mere targets alike.
    targets = edges.select(F.col("b").alias("address"), rule_for(host_of(F.col("target")), path_of(F.col("target")), rules)["verdict"].alias("verdict"))
    said = ruled.select("address", F.col("own.verdict").alias("verdict")).unionByName(targets).where("address IS NOT NULL AND verdict IS NOT NULL").distinct()
    # Spellings of one address are one node; an address without an edge is a group of its own.
    by_address = said.join(groups.withColumnRenamed("node", "address"), "address", "left").select(F.coalesce("component", "address").alias("component"), "verdict")
    decided = by_address.groupBy("component").agg(F.min("verdict").alias("group_verdict"))  # allow sorts before block
    members = ruled.join(groups.withColumnRenamed("node", "address"), "address", "left").withColumn("component", F.coalesce("component", "address"))
    return members.join(decided, "component", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "group_verdict", F.lit("allow")).alias("verdict"),
        "address",
        F.col("component").alias("alias_of"),
    )
