"""URL verdicts by rules, with blocks spread over redirect and canonical-link equivalence; DataFrame functions only."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

from tidemart.llm.common import once, written
from tidemart.llm.components import connected_components

#: (verdict, host/path)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://``; empty if there is none."""
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def squeezed(path: Column) -> Column:
    """The path without dot segments."""
    return F.when(path.rlike(r"/\.\.?(?:/|$)"), once(path, _squeezed)).otherwise(path)


def _squeezed(path: Column) -> Column:
    step = lambda kept, part: (
        F.when(part == ".", kept)
        .when(part == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1))))
        .otherwise(F.array_append(kept, part))
    )
    parts = F.split(path, "/")
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array(F.lit("")), step)
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    joined = F.array_join(ends, "/")
    return F.when(joined == "", F.lit("/")).otherwise(joined)


def with_key(df: DataFrame, url_col: str, name: str) -> DataFrame:
    """``name``: a URL's identity, null without a host: host without a default port, path without dot segments (``/`` if
    empty) and query, without scheme and fragment."""
    url = F.col(url_col)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    parts = df.withColumns({"_host": F.regexp_replace(host_of(url), ":(?:80|443)?$", ""), "_path": path_of(url), "_query": query})
    path = F.when(F.col("_path") == "", "/").otherwise(squeezed(F.col("_path")))
    return parts.withColumn(name, F.when(F.col("_host") != "", F.concat("_host", path, "_query"))).drop("_host", "_path", "_query")


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (of equally long ones an allow), else null."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "allow")):
        name, _, start = rule.partition("/")
        on_host = (host == name) | host.endswith("." + name)
        found = F.when(on_host & path.startswith("/" + start), F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules=RULES) -> Column:
    out = F.lit(None).cast("string")
    for verdict, name in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


_W = r"[ \t\n\r\f]"  #: white space of markup
_ATTRIBUTE = rf"""([^ \t\n\r\f/>=]+)(?:{_W}*+={_W}*+(?:"([^"]*)"|'([^']*)'|([^ \t\n\r\f>"'][^ \t\n\r\f>]*)))?"""
#: An attribute: name, then its value in double, single or no quotes.
ATTRIBUTE = f"(?is){_ATTRIBUTE}"
_INSIDE = rf"(?:[ \t\n\r\f/](?:[ \t\n\r\f/]|{_ATTRIBUTE})*+)?(?:={_W}*+)?>".replace("([^", "(?:[^")
_RAW = "|".join(rf"<{n}{_INSIDE}.*?(?:</{n}[ \t\n\r\f/>]|\z)" for n in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
#: The pieces of a page in one pass, quoted values whole in every tag: comments, elements whose content is text, the tags
#: that matter (the group), other tags, what looks like a tag, and a tag that never ends. Loops are possessive, so none
#: has a bound and none recurses.
PIECE = (
    rf"(?is)<!--(?:-?>|.*?(?:--!?>|\z))|{_RAW}|(<(?:link|meta|base|/?template){_INSIDE})|</?[a-z][^ \t\n\r\f/>]*+{_INSIDE}"
    r"|<[!?/][^>]*+>?|<[a-z].*\z"
)
#: A character reference as far as an attribute's value has them, or what is between.
REFERENCE = r"(?s)&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&"
WINDOWS = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}  #: what these numbers stand for
REFRESH = r"""(?is)^\s*[\d.]*\s*[;,]\s*(?:url\s*=\s*)?["']?([^"']*)"""
SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:"


def _map_of(entries: dict[str, str]) -> Column:
    """A map literal that is one string until the optimizer reads it."""
    return F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in entries.items())), F.lit("\x01"), F.lit("\x02"))


def decoded(value: Column) -> Column:
    """The value without character references: numbers, and the names of HTML; a name without semicolon only before what
    is neither a letter, a digit nor an equals sign, as in attributes."""
    names, windows = _map_of(html5), _map_of({str(n): c for n, c in WINDOWS.items()})

    def numbered(n: Column) -> Column:
        bad = n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, 0xFFFD).otherwise(n)), 8, "0")), "UTF-32")
        return F.when(n.between(0x80, 0x9F), F.try_element_at(windows, n.cast("string"))).otherwise(sign)

    def one(piece: Column) -> Column:
        digits = F.regexp_extract(piece, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
        number = F.when(piece.rlike("^&#[xX]"), F.conv(digits, 16, 10)).otherwise(digits)
        number = F.when(F.length(digits) > 7, 0x110000).otherwise(F.coalesce(number.try_cast("long"), F.lit(0)))
        return (
            F.when(piece.startswith("&#") & (F.length(piece) > 2), once(number, numbered))
            .when(piece.startswith("&"), F.coalesce(F.try_element_at(names, F.substr(piece, F.lit(2))), piece))
            .otherwise(piece)
        )

    whole = F.array_join(F.transform(F.regexp_extract_all(value, F.lit(REFERENCE), F.lit(0)), one), "")
    return F.when(value.contains("&"), whole).otherwise(value)


def resolved(target: Column, base: Column) -> Column:
    """The target against an absolute base URL, without dot segments; null for other schemes than http and https, and
    for empty targets."""
    whole = once(F.struct(target.alias("target"), base.alias("base")), lambda x: _resolved(x["target"], x["base"]))
    part = lambda u, n: F.regexp_extract(u, "(?s)^([^:]*://[^/?#]*)([^?#]*)(.*)$", n)
    return once(whole, lambda u: F.concat(part(u, 1), squeezed(part(u, 2)), part(u, 3)))


def _resolved(target: Column, base: Column) -> Column:
    scheme = F.regexp_extract(base, "^([^:/?#]*):", 1)
    site, path = F.concat(scheme, F.lit("://"), host_of(base)), path_of(base)
    folder = F.regexp_extract(path, "(?s)^(.*/)", 1)
    return (
        F.when((target == "") | target.startswith("#"), F.lit(None))
        .when(target.rlike(SCHEME), F.when(target.rlike("(?i)^https?://"), target))
        .when(~base.rlike("(?i)^https?://"), F.lit(None))
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(site, target))
        .when(target.startswith("?"), F.concat(site, path, target))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), target))
    )


def _outside(tags: Column) -> Column:
    """The tags that are in no template."""
    is_ = lambda t, start: F.lower(F.substring(t, 1, len(start))) == start
    state = lambda depth, kept: F.struct(depth.alias("depth"), kept.alias("kept"))

    def step(s: Column, t: Column) -> Column:
        return (
            F.when(is_(t, "<template"), state(s["depth"] + 1, s["kept"]))
            .when(is_(t, "</template"), state(F.greatest(s["depth"] - 1, F.lit(0)), s["kept"]))
            .when(s["depth"] == 0, state(s["depth"], F.array_append(s["kept"], t)))
            .otherwise(s)
        )

    nested = F.aggregate(tags, state(F.lit(0), F.array().cast("array<string>")), step)["kept"]
    return F.when(F.exists(tags, lambda t: is_(t, "<template")), nested).otherwise(F.filter(tags, lambda t: ~is_(t, "</template")))


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) for each canonical link and each refresh redirect in the pages' markup.

    Link elements count whose rel holds the word canonical, meta elements whose http-equiv is refresh; targets are
    resolved against the page's URL, or its first base element with a href. Comments, templates, elements whose content
    is text (scripts and the like) and other tags' attributes hold no elements; of an element's equal attributes the
    first counts. Tags, comments and character references are cut as browsers cut them, except that a tag with an
    attribute whose name begins with an equals sign counts as one that never ends, and what noscript holds counts.
    """
    found = F.filter(F.regexp_extract_all(html_col, F.lit(PIECE), F.lit(1)), lambda t: t != "")
    tags = pages.where(F.col(html_col).rlike("(?i)<(?:link|meta)[ \t\n\r\f/]")).select(F.col(url_col).alias("url"), _outside(found).alias("_tags"))

    def told(tag: Column) -> Column:
        body = F.regexp_replace(tag, "^<[A-Za-z]+", "")
        group = lambda n: F.regexp_extract_all(body, F.lit(ATTRIBUTE), F.lit(n))
        names = F.transform(group(1), lambda x: F.lower(x))
        joined = lambda a, b: F.zip_with(a, b, lambda x, y: F.concat(x, y))
        values = joined(joined(group(2), group(3)), group(4))
        value = lambda name: F.try_element_at(values, F.nullif(F.array_position(names, F.lit(name)).cast("int"), F.lit(0)))
        wanted = ("rel", "href", "http-equiv", "content")
        return F.struct(F.lower(F.regexp_extract(tag, "^<([A-Za-z]+)", 1)).alias("name"), *[decoded(value(w)).alias(w.replace("-", "_")) for w in wanted])

    elements = tags.select("url", F.transform("_tags", told).alias("_all"))
    target = lambda e: F.when(
        (e["name"] == "link") & F.array_contains(F.split(F.lower(e["rel"]), r"\s+"), "canonical"), e["href"]
    ).when((e["name"] == "meta") & (F.lower(F.trim(e["http_equiv"])) == "refresh"), F.regexp_extract(e["content"], REFRESH, 1))
    bases = F.filter("_all", lambda e: (e["name"] == "base") & e["href"].isNotNull())
    clean = lambda c: F.trim(F.regexp_replace(c, "[\t\n\r]", ""))
    found = elements.select("url", F.get(bases, 0)["href"].alias("_base"), F.explode(F.transform("_all", target)).alias("_target"))
    found = found.where("_target is not null")
    base = F.coalesce(resolved(clean(F.col("_base")), F.col("url")), F.col("url"))
    return found.select("url", resolved(clean(F.col("_target")), base).alias("target")).where("target is not null")


def judge(
    pages: DataFrame,
    rules=RULES,
    redirects: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """(id, host, path, rule, verdict) per page.

    A page's own rule decides. Without one, the URLs joined to it by redirects and canonical links (``redirects``:
    more pairs, columns ``url`` and ``target``) decide: one that a rule allows makes it allowed, else one that a rule
    blocks makes it blocked; else it is allowed. Null URLs and URLs without ``://`` have an empty host and path and no
    aliases; null markup has no links; repeated rows stay; an empty table gives an empty result.
    """
    links = alias_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    links = written(with_key(with_key(links, "url", "a"), "target", "b").where("a <> b"), "links")
    groups = connected_components(links, "a", "b")
    nodes = links.select(F.col("a").alias("node"), "url").union(links.select("b", "target")).distinct()
    ruled = nodes.withColumn("said", verdict_of(matching_rule(host_of(F.col("url")), path_of(F.col("url")), rules), rules))
    decided = (
        ruled.join(groups, "node")
        .groupBy("component")
        .agg(F.max((F.col("said") == "allow").cast("int")).alias("allow"), F.max((F.col("said") == "block").cast("int")).alias("block"))
    )
    spread = groups.join(decided, "component").select(
        F.col("node").alias("_key"), F.when(F.col("allow") == 1, "allow").when(F.col("block") == 1, "block").alias("_spread")
    )
    own = with_key(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url", "_key")
    own = own.select(
        F.col("_id").alias(id_col),
        F.coalesce(host_of(F.col("_url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("_url")), F.lit("")).alias("path"),
        "_key",
    )
    own = own.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    return own.join(spread, "_key", "left").select(
        id_col,
        "host",
        "path",
        "rule",
        F.coalesce(verdict_of(F.col("rule"), rules), "_spread", F.lit("allow")).alias("verdict"),
    )


def _duck_parts(url: str) -> tuple[str, str]:
    rest = f"substring({url}, instr({url}, '://') + 3)"
    host = f"translate(regexp_extract({rest}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}')"
    return host, f"regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1)"


def _duck_squeezed(path: str) -> str:
    kept = f"""list_reduce(list_prepend([''], list_transform(string_split({path}, '/')[2:], lambda x: [x])),
      lambda a, b: case when b[1] = '.' then a when b[1] = '..' then a[: greatest(len(a) - 1, 1)] else a || b end)"""
    ends = f"case when string_split({path}, '/')[-1] in ('.', '..') then {kept} || [''] else {kept} end"
    whole = f"array_to_string({ends}, '/')"
    dotted = f"regexp_matches({path}, '/\\.\\.?(/|$)')"
    return f"case when not {dotted} then {path} when {whole} = '' then '/' else {whole} end"


def _duck_key(url: str) -> str:
    host, path = _duck_parts(url)
    host = f"regexp_replace({host}, ':(80|443)?$', '')"
    query = f"regexp_extract(substring({url}, instr({url}, '://') + 3), '(?s)^[^?#]*(\\?[^#]*)', 1)"
    path = f"case when {path} = '' then '/' else {_duck_squeezed(path)} end"
    return f"case when instr({url}, '://') > 0 and {host} <> '' then {host} || {path} || {query} end"


def _duck_rule(host: str, path: str) -> str:
    whens = []
    for _, rule in sorted(RULES, key=lambda r: (-len(r[1]), r[0] != "allow")):
        name, _, start = rule.partition("/")
        whens.append(f"when ({host} = '{name}' or ends_with({host}, '.{name}')) and starts_with({path}, '/{start}') then '{rule}'")
    return f"case {' '.join(whens)} end"


def _duck_said(rule: str) -> str:
    return "case " + " ".join(f"when {rule} = '{r}' then '{v}'" for v, r in RULES) + " end"


def _duck_squeezed_url(url: str) -> str:
    part = lambda n: f"regexp_extract({url}, '(?s)^([^:]*://[^/?#]*)([^?#]*)(.*)$', {n})"
    return f"{part(1)} || {_duck_squeezed(part(2))} || {part(3)}"


def _duck_joined(target: str, base: str) -> str:
    host, path = _duck_parts(base)
    scheme = f"regexp_extract({base}, '^([^:/?#]*):', 1)"
    site, folder = f"{scheme} || '://' || {host}", f"regexp_extract({path}, '(?s)^(.*/)', 1)"
    return f"""case when {target} = '' or starts_with({target}, '#') then null
      when regexp_matches({target}, '{SCHEME}') then case when regexp_matches({target}, '(?i)^https?://') then {target} end
      when not coalesce(regexp_matches({base}, '(?i)^https?://'), false) then null
      when starts_with({target}, '//') then {scheme} || ':' || {target}
      when starts_with({target}, '/') then {site} || {target}
      when starts_with({target}, '?') then {site} || {path} || {target}
      else {site} || case when {folder} = '' then '/' else {folder} end || {target} end"""


def _duck_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _duck_decoded(value: str) -> str:
    digits = "regexp_extract(x, '^&#[xX]?0*([0-9a-fA-F]*)', 1)"
    number = f"""case when length({digits}) > 7 then 1114112 when {digits} = '' then 0
      when regexp_matches(x, '^&#[xX]') then ('0x' || {digits})::bigint else {digits}::bigint end"""
    bad = f"({number}) = 0 or ({number}) > 1114111 or ({number}) between 55296 and 57343"
    sign = f"""case when {bad} then chr(65533) when ({number}) between 128 and 159 then windows[({number}) - 127] else chr(({number})::int) end"""
    one = f"""case when starts_with(x, '&#') and length(x) > 2 then {sign}
      when starts_with(x, '&') then coalesce(signs[list_position(names, x[2:])], x) else x end"""
    return f"array_to_string(list_transform(regexp_extract_all({value}, '{REFERENCE}', 0), lambda x: {one}), '')"


def sql() -> str:
    """The same for DuckDB over ``pages``."""
    quoted = lambda x: x.replace("'", "''").replace("*+", "*")
    host, path = _duck_parts("url")
    t_host, t_path = _duck_parts("target")
    attribute = lambda name: _duck_decoded(f"v[list_position(n, '{name}')]")
    clean = lambda x: f"trim(regexp_replace({x}, '[\\t\\n\\r]', '', 'g'))"
    blank = lambda x: f"case when instr(url, '://') > 0 then {x} else '' end"
    return f"""
with recursive known as (
  select {_duck_list(html5)} as names, {_duck_list(html5.values())} as signs, {_duck_list(WINDOWS.values())} as windows
), found as (
  select row_number() over () as rid, url, list_filter(regexp_extract_all(html, '{quoted(PIECE)}', 1), lambda x: x <> '') as t from pages
), outside as (
  select rid, url, list_reduce(list_prepend({{'depth': 0, 'kept': []::varchar[]}}, list_transform(t, lambda x: {{'depth': 0, 'kept': [x]}})),
    lambda a, b: case when starts_with(lower(b.kept[1]), '<template') then {{'depth': a.depth + 1, 'kept': a.kept}}
      when starts_with(lower(b.kept[1]), '</template') then {{'depth': greatest(a.depth - 1, 0), 'kept': a.kept}}
      when a.depth = 0 then {{'depth': 0, 'kept': a.kept || b.kept}} else a end).kept as t
  from found where len(t) > 0
), tags as (
  select rid, url, unnest(t) as tag, generate_subscripts(t, 1) as place from outside
), split as (
  select rid, url, place, lower(regexp_extract(tag, '^<([A-Za-z]+)', 1)) as name, regexp_replace(tag, '^<[A-Za-z]+', '') as body from tags
), attributes as (
  select *, list_transform(regexp_extract_all(body, '{quoted(ATTRIBUTE)}', 1), lambda x: lower(x)) as n,
    list_transform(list_zip(regexp_extract_all(body, '{quoted(ATTRIBUTE)}', 2), regexp_extract_all(body, '{quoted(ATTRIBUTE)}', 3),
      regexp_extract_all(body, '{quoted(ATTRIBUTE)}', 4)), lambda x: coalesce(x[1], '') || coalesce(x[2], '') || coalesce(x[3], '')) as v
  from split
), elements as (
  select rid, url, place, name, case when list_contains(n, 'rel') then {attribute('rel')} end as rel,
    case when list_contains(n, 'href') then {attribute('href')} end as href,
    case when list_contains(n, 'http-equiv') then {attribute('http-equiv')} end as equiv,
    case when list_contains(n, 'content') then {attribute('content')} end as content
  from attributes, known
), bases as (
  select rid, arg_min(href, place) as base from elements where name = 'base' and href is not null group by rid
), wanted as (
  select rid, url, base, case when name = 'link' and list_contains(regexp_split_to_array(lower(rel), '\\s+'), 'canonical') then href
    when name = 'meta' and lower(trim(equiv)) = 'refresh' then regexp_extract(content, '{quoted(REFRESH)}', 1) end as raw
  from elements left join bases using (rid)
), cleaned as (
  select url, {clean('raw')} as raw, {clean('base')} as base from wanted where raw is not null
), based as (
  select url, raw, {_duck_joined('base', 'url')} as base from cleaned
), placed as (
  select url, raw, coalesce({_duck_squeezed_url('base')}, url) as base from based
), joined as (
  select url, {_duck_joined('raw', 'base')} as target from placed
), aimed as (
  select url, {_duck_squeezed_url('target')} as target from joined
), keyed as (
  select {_duck_key('url')} as a, {_duck_key('target')} as b, {_duck_said(_duck_rule(host, path))} as sa,
    {_duck_said(_duck_rule(t_host, t_path))} as sb
  from aimed where target is not null
), links as (
  select * from keyed where a <> b
), sides as (
  select a as x, b as y from links union select b, a from links
), reach as (
  select x, x as y from sides union select reach.x, sides.y from reach join sides on reach.y = sides.x
), said as (
  select a as y, sa as s from links union select b, sb from links
), spread as (
  select x, max(case when s = 'allow' then 1 else 0 end) as allow, max(case when s = 'block' then 1 else 0 end) as block
  from reach join said using (y) group by x
), own as (
  select page_id, coalesce({blank(host)}, '') as host, coalesce({blank(path)}, '') as path, {_duck_key('url')} as k from pages
), ruled as (
  select *, {_duck_rule('host', 'path')} as rule from own
)
select page_id, host, path, rule,
  coalesce({_duck_said('rule')}, case when allow = 1 then 'allow' when block = 1 then 'block' end, 'allow') as verdict
from ruled left join spread on spread.x = ruled.k
"""
