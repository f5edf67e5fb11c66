"""URL filters that see through redirects and canonical links.

Rules name a host, with all its subdomains, and a path prefix; the longest rule that fits a URL
decides. Redirects (``meta refresh``) and canonical links tie URLs that name one resource. The
distributed components of these links carry decisions to their aliases: a URL that no rule fits
is allowed if any alias has an explicit allow, else blocked if any has a block, else allowed.

Null URLs and URLs without ``://`` have an empty host and path, fit no rule, have no aliases and
are allowed. Columns that the operator makes replace columns of the same names; all others are kept.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.components import components
from rosterflow.session import materialise

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """``site`` is a host and a path prefix, like ``example.net/en/``."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.site.partition("/")[2]


_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed patterns of what is no markup of the page, of the two kinds of links in it, and of their targets.
NO_MARKUP = r"""(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)"""
CANONICAL_TAG = r"""(?is)<link\b[^>]*\srel\s*=\s*["']?(?:[^"'>]*\s)?canonical(?:["'\s/][^>]*)?>"""
REFRESH_TAG = r"""(?is)<meta\b[^>]*\shttp-equiv\s*=\s*["']?refresh(?:["'\s/][^>]*)?>"""
CANONICAL_TARGET = r"""(?is)\shref\s*=\s*["']?([^"'\s>]+)"""
REFRESH_TARGET = r"""(?is)[\s;"']url\s*=\s*["']?([^"'\s>]+)"""
#: The element that names what relative targets are relative to; its target is read as a canonical link's.
BASE_TAG = r"""(?is)<base\b[^>]*\shref\s*=[^>]*>"""
#: Character references and what lies between them, and those that are decoded by name.
_REFERENCES = r"(?s)&#[0-9]{1,7};?|&#[xX][0-9a-fA-F]{1,6};?|&[a-zA-Z]+;|[^&]+|&"
_NAMED = {"&amp;": "&", "&AMP;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'"}


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def resource_of(url: Column) -> Column:
    """What names a resource: host, path and query, without scheme and fragment; null if there is no host. No path is ``/``."""
    host, path = host_of(url), path_of(url)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), F.coalesce(F.regexp_extract(url, _URL, 3), F.lit(""))))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, an allow before a block of the same length; null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r.site), r.verdict != ALLOW, r.site))
    options = [F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.lit(r.site)) for r in ordered]
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def verdict_of(rule: Column, rules: list[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.site, F.lit(r.verdict)).otherwise(out)
    return out


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that stands once in the plan, however often ``use`` takes it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def decoded(text: Column) -> Column:
    """Numeric character references and the named ones of markup as their characters."""

    def one(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^&#([0-9]+);?$", 1)
        hexadecimal = F.regexp_extract(piece, "^&#[xX]([0-9a-fA-F]+);?$", 1)
        code = F.coalesce(F.conv(F.nullif(hexadecimal, F.lit("")), 16, 10), F.nullif(digits, F.lit(""))).cast("long")

        def character(c: Column) -> Column:
            valid = c.between(1, 0xD7FF) | c.between(0xE000, 0x10FFFF)
            return F.decode(F.unhex(F.lpad(F.hex(F.when(valid, c).otherwise(0xFFFD)), 8, "0")), "UTF-32")

        out = F.when(piece.rlike("^&#[xX]?[0-9a-fA-F]+;?$"), _once(code, character))
        for name, value in _NAMED.items():
            out = out.when(piece == name, value)
        return out.otherwise(piece)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCES), F.lit(0)), one), "")


def _without_dots(path: Column) -> Column:
    """A path that begins with a slash, its ``.`` and ``..`` segments resolved."""

    def step(held: Column, part: Column) -> Column:
        up = F.slice(held, 1, F.greatest(F.size(held) - 1, F.lit(0)))
        return F.when(part == ".", held).when(part == "..", up).otherwise(F.concat(held, F.array(part)))

    # a last segment of dots names a folder
    parts = F.split(F.regexp_replace(F.substring(path, 2, 1 << 30), r"(^|/)(\.\.?)$", "$1$2/"), "/")
    return F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))


def resolved(base: Column, target: Column) -> Column:
    """The URL that a target names in a document of URL ``base``; null if it has a scheme but no host."""
    return _once(base, lambda b: _once(target, lambda t: _resolved(b, t)))


def _resolved(base: Column, target: Column) -> Column:
    path, rest = F.regexp_extract(target, "(?s)^([^?#]*)", 1), F.regexp_extract(target, "(?s)^[^?#]*(.*)$", 1)
    site, own = F.concat(F.lit("x://"), host_of(base)), path_of(base)
    folder = F.when(own == "", "/").otherwise(F.regexp_extract(own, "(?s)^(.*/)", 1))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target))
        .when(F.startswith(target, F.lit("//")), F.concat(F.lit("x:"), target))
        .when((path == "") & F.startswith(rest, F.lit("?")), F.concat(site, own, rest))
        .when(path == "", base)
        .when(F.startswith(path, F.lit("/")), F.concat(site, _without_dots(path), rest))
        .otherwise(F.concat(site, _without_dots(F.concat(folder, path)), rest))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` resources tied by a canonical link or a redirect in a page.

    Targets may be absolute or relative to the page, or to what its first ``base`` names; character
    references in them are decoded. Targets with a scheme but no host are left out, and so is what looks like a
    link in a comment, script or style.
    """
    linking = F.col("html").rlike(CANONICAL_TAG) | F.col("html").rlike(REFRESH_TAG)
    html = F.when(linking, F.regexp_replace("html", NO_MARKUP, ""))
    tags = F.concat(
        F.transform(F.regexp_extract_all(html, F.lit(CANONICAL_TAG), F.lit(0)), lambda t: F.regexp_extract(t, CANONICAL_TARGET, 1)),
        F.transform(F.regexp_extract_all(html, F.lit(REFRESH_TAG), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH_TARGET, 1)),
    )
    named = decoded(F.regexp_extract(F.regexp_extract(html, BASE_TAG, 0), CANONICAL_TARGET, 1))
    found = pages.filter(html.isNotNull()).select("url", resource_of(F.col("url")).alias("src"), F.when(F.size(tags) > 0, named).alias("named"), F.explode(tags).alias("target"))
    found = found.filter(F.col("src").isNotNull() & (F.col("target") != ""))
    base = F.when(F.col("named") != "", resolved(F.col("url"), F.col("named")))
    found = found.select("src", F.coalesce(base, F.col("url")).alias("base"), decoded(F.col("target")).alias("target"))
    return found.select("src", _once(resolved(F.col("base"), F.col("target")), resource_of).alias("dst")).filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst"))).distinct()


def judge(pages: DataFrame, rules: list[Rule], links: DataFrame | None = None) -> DataFrame:
    """All columns of ``pages``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``links`` has ``src`` and ``dst`` resources; without it the links in the pages' html are taken.
    """
    given = pages.drop("host", "path", "rule", "verdict", "resource")
    links = materialise(page_links(given) if links is None else links, "page-links")
    placed = components(links)
    ends = placed.unionByName(placed.select(F.col("component").alias("node"), "component")).distinct()
    # the links' ends are decided by the rules even where they are no page themselves
    url = F.concat(F.lit("x://"), F.col("node"))
    decided = ends.withColumn("verdict", verdict_of(fitting_rule(host_of(url), path_of(url), rules), rules))
    groups = decided.groupBy("component").agg(F.max((F.col("verdict") == ALLOW).cast("int")).alias("allowed"), F.max((F.col("verdict") == BLOCK).cast("int")).alias("blocked"))
    carried = F.when(F.col("allowed") == 1, ALLOW).when(F.col("blocked") == 1, BLOCK)
    aliases = ends.join(groups, "component").select(F.col("node").alias("resource"), carried.alias("carried")).filter(F.col("carried").isNotNull())

    named = given.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), resource_of(F.col("url")).alias("resource"))
    named = named.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    joined = named.join(aliases, "resource", "left")
    verdict = F.coalesce(verdict_of(F.col("rule"), rules), F.col("carried"), F.lit(ALLOW))
    return joined.select(*given.columns, "host", "path", "rule", verdict.alias("verdict"))
