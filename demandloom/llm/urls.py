"""URL rules, and block decisions that reach the aliases of a blocked page.

Two addresses are aliases when a redirect or a canonical link joins them, directly or over
others. Aliases are the connected components of those edges. A page's own rule decides first, so
an explicit allow stands even if an alias is blocked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the check, (host and path, verdict).
RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
MAX_RULES = 2_000
#: What browsers do not read as tags.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(?:script|style|textarea|title)\b.*?(?:</(?:script|style|textarea|title)\b|\z)"
TAGS = r"(?is)<(?:link|meta)[\s/][^>]*>"
BASE = r"(?is)<base[\s/](?:[^>]*[\s\"'/])?href\s*=[^>]*>"
#: Entities that can stand in an address, but for numbers; ``&amp;`` comes last.
ENTITIES = [("&quot;", '"'), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value worked out once, however often ``of`` names it. Written out, a link's
    address repeats what it is made of at every step, and the plan grows by a factor with each."""
    return F.transform(F.array(value), of)[0]


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. ``rules`` is a short list kept in the plan."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = []
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        cut = rule.index("/")
        inside = (host == rule[:cut]) | host.endswith("." + rule[:cut])
        fits.append(F.when(inside & path.startswith(rule[cut:]), rule))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def address(url: Column) -> Column:
    """One spelling per address: no scheme, no ``www.``, no port that the scheme has anyway, no
    fragment, no slash at the path's end. Null if there is no ``://``."""
    return once(url, _address)


def _address(url: Column) -> Column:
    query = F.regexp_extract(url, r"(?s)^[^?#]*(\?[^#]*)", 1)
    port = F.when(url.rlike("(?i)^https:"), ":(443)?$").when(url.rlike("(?i)^http:"), ":(80)?$").otherwise(":$")
    named = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), port, F.lit(""))
    plain = F.concat(named, F.regexp_replace(path(url), "/+$", ""), query)
    return F.when(F.contains(url, F.lit("://")), plain)


def _plain_path(path: Column) -> Column:
    """A path that begins with '/', without its segments '.' and '..'."""
    return once(F.split(path, "/"), _joined)


def _joined(parts: Column) -> Column:
    kept = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"))


def resolve(target: Column, base: Column) -> Column:
    """The absolute address that a link on the page ``base`` leads to; null for schemes without
    ``://`` and for a base without one. Absolute targets stay as they are."""
    return once(target, lambda t: once(base, lambda b: _resolve(t, b)))


def _resolve(target: Column, base: Column) -> Column:
    root = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    own = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    folder = F.concat(F.lit("/"), F.regexp_extract(path(base), r"(?s)^/(.*/)", 1))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | ~F.contains(base, F.lit("://")), None)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^(.*?:)//", 1), target))
        .when(target.startswith("/"), F.concat(root, _plain_path(own), rest))
        .when(own != "", F.concat(root, _plain_path(F.concat(folder, own)), rest))
        .when(rest.startswith("?"), F.concat(root, path(base), rest))
        .otherwise(base)
    )


def unquoted(value: Column) -> Column:
    """What stands within the quotes that a text begins with; other texts as they are."""
    return once(value, _unquoted)


def _unquoted(value: Column) -> Column:
    return (
        F.when(value.startswith('"'), F.regexp_extract(value, '(?s)^"([^"]*)', 1))
        .when(value.startswith("'"), F.regexp_extract(value, "(?s)^'([^']*)", 1))
        .otherwise(value)
    )


def decoded(text: Column) -> Column:
    """A text with its character references resolved: numbers, and the five that XML names. Others stay."""
    return once(text, _decoded)


def _decoded(text: Column) -> Column:
    def number(entity: Column) -> Column:
        digits = F.regexp_extract(entity, "[0-9A-Fa-f]+", 0)
        return F.when(entity.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("int")

    def resolved(now: Column, entity: Column) -> Column:
        n = number(entity)
        character = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF), F.replace(now, entity, character)).otherwise(now)

    found = F.regexp_extract_all(text, F.lit("(&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});)"))
    plain = F.aggregate(F.array_distinct(found), text, resolved)
    for entity, character in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(character))
    return plain


def attribute(tag: Column, name: str) -> Column:
    """The value of the first attribute of that name in a tag, decoded and trimmed; empty if there is none."""
    found = F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)""", 1)
    return F.btrim(decoded(unquoted(found)), F.lit(" \t\n\f\r"))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (u, v) of addresses: all canonical links and refresh redirects in the pages' HTML.

    Comments, scripts, styles and titles are no HTML here. Attribute values may stand in either
    kind of quotes, which may hold the other kind, or in none; a ``>`` ends a tag even in quotes.
    ``rel`` may list further words. Relative targets are resolved against the page's first
    ``<base>``, else against its own address. Null HTML, and pages without any link, give none.
    """
    shown = pages.filter(F.col(html).rlike("(?i)canonical|refresh")).select(
        F.col(url).alias("page"), F.regexp_replace(F.col(html), HIDDEN, " ").alias("shown")
    )
    tags = shown.select(
        "page", F.regexp_extract("shown", BASE, 0).alias("base_tag"),
        F.explode(F.regexp_extract_all("shown", F.lit(TAGS), 0)).alias("tag"),
    ).filter(F.col("tag").rlike("(?i)canonical|refresh"))
    tag, base = F.col("tag"), attribute(F.col("base_tag"), "href")
    is_link = tag.rlike("(?i)^<link") & F.array_contains(F.split(F.lower(attribute(tag, "rel")), r"\s+"), "canonical")
    is_turn = tag.rlike("(?i)^<meta") & (F.lower(attribute(tag, "http-equiv")) == "refresh")
    content = F.regexp_replace(attribute(tag, "content"), r"\s+", " ")
    turn = F.regexp_extract(content, r"(?i)^[0-9.]* ?[;, ] ?(?:url ?= ?)?(.*)$", 1)
    linked = tags.select(
        "page", base.alias("base"),
        F.when(is_link, attribute(tag, "href")).when(is_turn, F.btrim(unquoted(turn))).alias("target"),
    ).filter("target <> ''")
    base = F.when(F.col("base") == "", F.col("page")).otherwise(F.coalesce(resolve(F.col("base"), F.col("page")), "page"))
    return (
        linked.select("page", "target", base.alias("base"))
        .select(address(F.col("page")).alias("u"), address(resolve(F.col("target"), F.col("base"))).alias("v"))
        .filter("u is not null and v is not null and u <> v")
    )


def judge(
    pages: DataFrame,
    links: DataFrame,
    rules: list[tuple[str, str]] = RULES,
    url: str = "url",
    keys: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """``keys``, host, path, rule, verdict and alias_blocked of every page.

    ``links`` has edges (u, v) between addresses as ``address`` spells them. A page with a rule
    gets its verdict. A page without one is blocked if any page of its address or of an alias
    has a block rule, and allowed otherwise. A null url, or one without ``://``, has empty host
    and path, no alias and no rule. Repeated rows stay; empty tables give an empty table; further
    columns are left behind.
    """
    verdicts = dict(rules)
    named = pages.select(
        *keys, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), address(F.col(url)).alias("__address")
    ).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    blocking = [r for r, v in verdicts.items() if v == "block"]
    named = named.withColumn("__blocks", F.coalesce(F.col("rule").isin(blocking), F.lit(False)))
    members = components(links)
    alias = named.join(members, named["__address"] == members["node"], "left").withColumn(
        "__group", F.coalesce("component", "__address")
    )
    blocked = alias.filter("__blocks").groupBy("__group").agg(F.lit(True).alias("__blocked"))
    blocked = blocked.withColumnRenamed("__group", "__blocked_group")
    reached = alias.join(blocked, F.col("__group") == F.col("__blocked_group"), "left")
    own = F.create_map(*(F.lit(x) for r in verdicts.items() for x in r))[F.col("rule")]
    return reached.select(
        *keys, "host", "path", "rule",
        F.coalesce(own, F.when(F.col("__blocked"), "block"), F.lit("allow")).alias("verdict"),
        F.coalesce("__blocked", F.lit(False)).alias("alias_blocked"),
    )
