"""The SQL of ``op6_urls``: the rules of ``urls`` once more, from pieces that several places need."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _host(url: str) -> str:
    return f"translate(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), {_LOWER})"


def _path(url: str) -> str:
    return f"regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's')"


def _address(url: str) -> str:
    port = f"""case when regexp_matches({url}, '(?i)^https:') then ':(443)?$'
      when regexp_matches({url}, '(?i)^http:') then ':(80)?$' else ':$' end"""
    return rf"""regexp_replace(regexp_replace({_host(url)}, '^www\.', ''), {port}, '')
    || regexp_replace({_path(url)}, '/+$', '') || regexp_extract({url}, '^[^?#]*(\?[^#]*)', 1, 's')"""


def _plain_path(path: str) -> str:
    """Without the segments '.' and '..'; every segment is a list of its own, as the fold needs one type."""
    parts = f"list_transform(string_split({path}, '/')[2:], lambda x: [x])"
    fold = """lambda done, x: case when x[1] = '.' then done
        when x[1] = '..' then list_slice(done, 1, greatest(len(done) - 1, 0)) else list_concat(done, x) end"""
    return f"'/' || array_to_string(list_reduce(list_concat([[]::varchar[]], {parts}), {fold}), '/')"


def _resolved(target: str, base: str) -> str:
    own, rest = f"regexp_extract({target}, '^([^?#]*)', 1, 's')", f"regexp_extract({target}, '^[^?#]*(.*)$', 1, 's')"
    root = f"regexp_extract({base}, '^(.*?://[^/?#]*)', 1, 's')"
    below = f"('/' || regexp_extract({_path(base)}, '^/(.*/)', 1, 's') || {own})"
    return f"""case when regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*://') then {target}
    when regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*:') or not contains({base}, '://') then null
    when starts_with({target}, '//') then regexp_extract({base}, '^(.*?:)//', 1, 's') || {target}
    when starts_with({target}, '/') then {root} || {_plain_path(own)} || {rest}
    when {own} <> '' then {root} || {_plain_path(below)} || {rest}
    when starts_with({rest}, '?') then {root} || {_path(base)} || {rest}
    else {base} end"""


def _unquoted(value: str) -> str:
    return f"""case when starts_with({value}, '"') then regexp_extract({value}, '^"([^"]*)', 1, 's')
    when starts_with({value}, '''') then regexp_extract({value}, '^''([^'']*)', 1, 's') else {value} end"""


def _decoded(value: str) -> str:
    number = """case when lower(e[3]) = 'x' then ('0x' || regexp_extract(e, '[0-9A-Fa-f]+', 0))::int
      else regexp_extract(e, '[0-9]+', 0)::int end"""
    found = f"regexp_extract_all({value}, '&#(?:[0-9]{{1,7}}|[xX][0-9A-Fa-f]{{1,6}});')"
    plain = f"""list_reduce(list_concat([{value}], list_distinct({found})), lambda now, e:
      case when {number} between 1 and 55295 or {number} between 57344 and 1114111 then replace(now, e, chr({number})) else now end)"""
    for entity, character in (("&quot;", '"'), ("&apos;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = f"replace({plain}, '{entity}', '{character}')"
    return plain


def _raw_attribute(tag: str, name: str) -> str:
    pattern = rf"""'[\s"''/]{name}\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>][^\s>]*)'"""
    return f"regexp_extract({tag}, {pattern}, 1, 'is')"


def _trimmed(value: str) -> str:
    return f"trim({value}, ' ' || chr(9) || chr(10) || chr(12) || chr(13))"


_NAMES = {"rel": ("tag", "rel"), "equiv": ("tag", "http-equiv"), "href": ("tag", "href"), "content": ("tag", "content"), "base": ("base_tag", "href")}
_raw = ",\n    ".join(f"{_raw_attribute(*v)} as {k}" for k, v in _NAMES.items())
_bare = ",\n    ".join(f"{_unquoted(k)} as {k}" for k in _NAMES)
_attributes = ",\n    ".join(f"{_trimmed(_decoded(k))} as {k}" for k in _NAMES)

OP6_SQL = rf"""
with recursive named as (
  select page_id, html, coalesce({_host("url")}, '') as host, coalesce({_path("url")}, '') as path,
    case when contains(url, '://') then url end as url
  from pages
), ruled as (
  select *,
    case
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
      when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
      when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
      when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/'
    end as rule,
    {_address("url")} as address
  from named
), shown as (
  select url as page, regexp_replace(html,
    '<!--.*?(?:-->|\z)|<(?:script|style|textarea|title)\b.*?(?:</(?:script|style|textarea|title)\b|\z)', ' ', 'gis') as shown
  from named where url is not null and regexp_matches(html, '(?i)canonical|refresh')
), tags as (
  select page, regexp_extract(shown, '<base[\s/](?:[^>]*[\s"''/])?href\s*=[^>]*>', 0, 'is') as base_tag,
    unnest(regexp_extract_all(shown, '<(?:link|meta)[\s/][^>]*>', 0, 'is')) as tag
  from shown
), raw as (
  select page, tag, {_raw}
  from tags where regexp_matches(tag, '(?i)canonical|refresh')
), bare as (
  select page, tag, {_bare}
  from raw
), attributes as (
  select page, tag, {_attributes}
  from bare
), turned as (
  select *, regexp_extract(regexp_replace(content, '\s+', ' ', 'g'), '^[0-9.]* ?[;, ] ?(?:url ?= ?)?(.*)$', 1, 'i') as turn
  from attributes
), targets as (
  select page, case when base = '' then page else coalesce({_resolved("base", "page")}, page) end as base,
    case when tag ilike '<link%' and list_contains(regexp_split_to_array(lower(rel), '\s+'), 'canonical') then href
      when tag ilike '<meta%' and lower(equiv) = 'refresh' then trim({_unquoted("turn")}) end as target
  from turned
), absolute as (
  select page, {_resolved("target", "base")} as target from targets where target <> ''
), links as (
  select {_address("page")} as u, {_address("target")} as v from absolute where contains(target, '://')
), both_ways as (select u, v from links union select v, u from links),
reach as (
  select distinct address as start, address as now from ruled where rule in ('com/de/', 'example.org/es/', 'example.org/en/1')
  union
  select start, v from reach join both_ways on now = u
), blocked as (select distinct now as address from reach)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when address in (select address from blocked) then 'block' else 'allow' end as verdict
from ruled
"""
