"""URL and anchor expressions: everything stays inside Catalyst, no parser objects per row."""
from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of HTML and RFC 3986. Repeated groups are possessive: the matcher then loops instead
# of recursing once per repetition.
_INVISIBLE = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
_ANCHOR = r"""(?is)<a(\s(?:"[^"]*"|'[^']*'|[^'">]++)*+)>"""
_ATTRIBUTE = r"""(?s)([^\s=>"'/]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?"""
_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"

# Named references as the standard library lists them. Those that hold without a semicolon may be followed by anything.
_LONGEST_OPEN = max(len(name) for name in html5 if not name.endswith(";"))
# Numbers of the C1 controls stand for the characters of the Windows code page, and 0 for none that exists.
_REREAD = {0: "\ufffd"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def anchor_hrefs(html: Column) -> Column:
    """ARRAY<STRING> of the href values of all ``<a>`` tags, in document order."""
    visible = F.regexp_replace(html, _INVISIBLE, "")
    tags = F.regexp_extract_all(visible, F.lit(_ANCHOR), F.lit(1))

    def hrefs(tag: Column) -> Column:
        names = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(1))
        values = F.regexp_extract_all(tag, F.lit(_ATTRIBUTE), F.lit(2))
        pairs = F.arrays_zip(names.alias("name"), values.alias("value"))
        wanted = F.filter(pairs, lambda p: (F.lower(p["name"]) == "href") & (p["value"] != ""))
        return F.transform(wanted, lambda p: _unquote_attribute(p["value"]))

    return F.filter(F.flatten(F.transform(tags, hrefs)), lambda h: h != "")


def _unquote_attribute(value: Column) -> Column:
    quoted = F.substring(value, 1, 1).isin('"', "'")
    text = F.when(quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
    return F.btrim(without_references(text), F.lit(" \t\n\r\f"))


def without_references(text: Column) -> Column:
    """Character references (named, decimal, hexadecimal) as the characters they mean; of a name the longest known beginning
    counts, and what is no reference stays. Each ``&`` is looked at once, so nothing is decoded twice."""
    parts = F.split(text, "&", -1)
    decoded = F.concat(F.array(F.get(parts, F.lit(0))), F.transform(F.slice(parts, F.lit(2), F.size(parts)), _referred))
    return F.when(text.contains("&"), F.array_join(decoded, "")).otherwise(text)


def _referred(rest: Column) -> Column:
    """``&`` and what follows it, up to the next one."""
    table = F.from_json(F.lit(json.dumps(html5)), "MAP<STRING, STRING>")
    name = F.regexp_extract(rest, r"\A[^\t\n\f <#;]{1,32};?", 0)
    lengths = F.array(F.length(name), *[F.lit(n) for n in range(_LONGEST_OPEN, 1, -1)])
    known = F.filter(lengths, lambda n: (n <= F.length(name)) & F.map_contains_key(table, F.substring(name, F.lit(1), n)))
    longest = F.get(known, F.lit(0))
    named = F.when(
        longest.isNotNull(),
        F.concat(F.element_at(table, F.substring(name, F.lit(1), longest)), F.substring(rest, longest + 1, F.length(rest))),
    )
    number = F.regexp_extract(rest, r"\A#(?:[0-9]+|[xX][0-9a-fA-F]+);?", 0)
    numbered = F.concat(_character(number), F.substring(rest, F.length(number) + 1, F.length(rest)))
    return F.when(number != "", numbered).otherwise(F.coalesce(named, F.concat(F.lit("&"), rest)))


def _character(number: Column) -> Column:
    """The character of ``#65;`` or ``#x41;``; none for numbers that name no character."""
    digits = F.regexp_extract(number, r"\A#[xX]?0*([0-9a-fA-F]*)", 1)
    is_hex = F.lower(number).startswith("#x")
    # eight digits are beyond all characters in either base
    short = F.when(F.length(digits) > 7, F.lit("9999999")).when(digits == "", F.lit("0")).otherwise(digits)
    code = F.when(is_hex, F.conv(short, 16, 10)).otherwise(short).cast("bigint")
    replaced = F.create_map(*[F.lit(x) for pair in _REREAD.items() for x in pair])
    lost = code.between(0xD800, 0xDFFF) | (code > 0x10FFFF)
    control = code.between(1, 0x1F) & ~code.isin(0x9, 0xA, 0xC, 0xD) | (code == 0x7F)
    never = code.between(0xFDD0, 0xFDEF) | ((code % 0x10000) >= 0xFFFE)
    return (
        F.when(F.map_contains_key(replaced, code.cast("int")), F.try_element_at(replaced, code.cast("int")))
        .when(lost, F.lit("\ufffd"))
        .when(control | never, F.lit(""))
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def url_parts(url: Column) -> Column:
    """STRUCT(scheme, authority, path, query, fragment) with '' for absent parts."""
    names = ("scheme", "authority", "path", "query", "fragment")
    return F.struct(*[F.regexp_extract(url, _URL, i).alias(n) for i, n in enumerate(names, 1)])


def _without_dots(path: Column) -> Column:
    """Remove '.' and '..' segments; a leading slash is kept, climbing above the root is ignored."""
    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1)
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closing = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.concat(F.lit("/"), F.array_join(closing, "/"))


def resolved_parts(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` (both whole URLs) to the parts of the absolute URL."""
    b, h = url_parts(base), url_parts(href)
    own_authority = (h["scheme"] != "") & (F.lower(h["scheme"]) != F.lower(b["scheme"])) | (h["authority"] != "")
    folder = F.regexp_replace(b["path"], r"[^/]*$", "")
    relative = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), h["path"])
    path = (
        F.when(own_authority | h["path"].startswith("/"), h["path"])
        .when(h["path"] == "", b["path"])
        .otherwise(relative)
    )
    needs_cleaning = ~own_authority & path.startswith("/") & path.rlike(r"/\.\.?(/|$)")
    return F.struct(
        F.lower(F.when(h["scheme"] != "", h["scheme"]).otherwise(b["scheme"])).alias("scheme"),
        F.when(own_authority, h["authority"]).otherwise(b["authority"]).alias("authority"),
        F.when(needs_cleaning, _without_dots(path)).otherwise(path).alias("path"),
        F.when((h["path"] == "") & ~own_authority & (h["query"] == ""), b["query"]).otherwise(h["query"]).alias("query"),
        h["fragment"].alias("fragment"),
    )


def percent_decoded(text: Column) -> Column:
    """Decode %XX; '+' is an ordinary character in a path, and malformed input is left as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def origin(url: Column) -> Column:
    """``scheme://authority/`` of a URL."""
    parts = url_parts(url)
    return F.concat(F.lower(parts["scheme"]), F.lit("://"), parts["authority"], F.lit("/"))
