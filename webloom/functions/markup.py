"""Titles and links of pages as column expressions.

All markup but titles, links and the few elements that decide whether these count is cut away by one regular
expression, whose alternatives are tried where a ``<`` stands: comments, raw text elements and tags cut off by the end of
the page go as a whole, so what they hold is not taken for markup. Its repetitions are possessive, hence a
page of any kind is read in linear time. What is left is a short list of tags. Nothing here runs in Python.
"""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_INSIDE = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+)?+)*+"""
_NAME_ENDS = r"(?=[\s/>])"
# Elements whose content is text, and those that decide what counts.
_RAW = "script|style|xmp|iframe|noembed|noframes|noscript|textarea"
_DECIDING = "template|svg|math|select"
_ENDS_SELECT = "input|keygen"
_TITLE = rf"<title{_NAME_ENDS}{_INSIDE}>.*?(?:</title{_NAME_ENDS}[^>]*+>?|\z)"
_OTHER_MARKUP = (
    r"(?is)<!--(?:-?>|.*?(?:--!?>|\z))"
    rf"|<({_RAW}){_NAME_ENDS}{_INSIDE}>.*?(?:</\1{_NAME_ENDS}[^>]*+>?|\z)"
    rf"|<plaintext{_NAME_ENDS}{_INSIDE}>.*\z"
    rf"|({_TITLE}|<a{_NAME_ENDS}{_INSIDE}>|</?(?:{_DECIDING}){_NAME_ENDS}{_INSIDE}>|<(?:{_ENDS_SELECT}){_NAME_ENDS}{_INSIDE}>)"
    rf"|</?[a-z][^\s/>]*+{_INSIDE}>"
    r"|<(?:[!?]|/(?=[^a-z]))[^>]*+(?:>|\z)"
    r"|</?[a-z].*\z"
    r"|[^<]++|<"
)
_KEPT = rf"(?is){_TITLE}|<[^>=]*+{_INSIDE}>"
_ATTRIBUTE = r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


# --- character references -------------------------------------------------------------------


def _tables() -> tuple[Column, Column]:
    """Named references, and the characters that some numbers stand for."""
    # numbers from 128 on mean what they mean in windows-1252, where that has a character
    western = {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
    numbers = {str(n): c for n, c in (western | {0: "�", 0x0D: "\r"}).items()}
    return tuple(F.from_json(F.lit(json.dumps(t)), "map<string,string>") for t in (html5, numbers))


def _numbered(digits: Column, base: int, numbers: Column) -> Column:
    """The character of a number; a replacement character where there is none, nothing for those that are not allowed."""
    short = F.regexp_replace(digits, "^0+(?=.)", "")
    value = F.when(F.length(short) <= 8, F.conv(short, base, 10).cast("bigint")).otherwise(F.lit(1 << 40))

    def character(n: Column) -> Column:
        forbidden = (
            n.between(1, 8) | n.between(0x0E, 0x1F) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | (n == 0x0B)
            | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE)
        )
        return (
            F.when(F.map_contains_key(numbers, n.cast("string")), F.element_at(numbers, n.cast("string")))
            .when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "�").when(forbidden, "")
            .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        )

    return _let(value, character)


def _named(name: Column, names: Column) -> Column:
    """The characters of a named reference without its ``&``, and what is behind the longest name that it begins with."""
    def decoded(known: Column) -> Column:
        return F.concat(F.element_at(names, known), name.substr(F.length(known) + 1, F.length(name)))

    beginnings = F.transform(F.sequence(F.length(name), F.lit(2), F.lit(-1)), lambda n: name.substr(F.lit(1), n))
    known = F.get(F.filter(beginnings, lambda part: F.map_contains_key(names, part)), F.lit(0))
    plain = F.concat(F.lit("&"), name)
    return F.when(F.length(name) < 2, plain).otherwise(_let(known, lambda k: F.when(k.isNull(), plain).otherwise(decoded(k))))


def decoded_references(text: Column, attribute: bool = False) -> Column:
    """Text with its character references decoded. In an attribute a name without a semicolon stays as typed
    before ``=`` or further letters."""
    names, numbers = _tables()
    reference = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)(=?)" if attribute else r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"

    def one(found: Column) -> Column:
        body = F.regexp_extract(found, reference, 1)
        number = F.regexp_extract(body, "^#([0-9]+)", 1)
        hexadecimal = F.regexp_extract(body, "^#[xX]([0-9a-fA-F]+)", 1)
        named = _named(body, names)
        if attribute:
            behind = F.regexp_extract(found, reference, 2)
            named = F.when(body.endswith(";") | ((behind == "") & F.map_contains_key(names, body)), named).otherwise(F.concat(F.lit("&"), body))
        out = F.when(number != "", _numbered(number, 10, numbers)).when(hexadecimal != "", _numbered(hexadecimal, 16, numbers)).otherwise(named)
        return F.concat(out, behind) if attribute else out

    between = F.split(text, reference)
    found = F.transform(F.regexp_extract_all(text, F.lit(reference), F.lit(0)), one)
    joined = F.array_join(F.zip_with(between, found, lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))), "")
    return F.when(text.contains("&"), joined).otherwise(text)


# --- what counts on a page -------------------------------------------------------------------


def page_tags(html: Column) -> Column:
    """The titles, with their content, links and deciding tags of a page, in order."""
    clean = F.when(html.rlike(r"[\x00\r]"), F.translate(F.replace(html, F.lit("\r"), F.lit("\n")), "\0", "")).otherwise(html)
    return F.regexp_extract_all(F.regexp_replace(clean, _OTHER_MARKUP, "$2"), F.lit(_KEPT), F.lit(0))


def _content(title: Column) -> Column:
    opened = F.regexp_replace(title, rf"(?is)^<title{_NAME_ENDS}{_INSIDE}>", "")
    return F.regexp_replace(opened, rf"(?is)</title{_NAME_ENDS}[^>]*+>?\z", "")


def _href(tag: Column, foreign: Column) -> Column:
    """The target of a link tag, NULL if it has none. Most tags begin with it."""
    attributes = F.regexp_extract_all(tag.substr(F.lit(3), F.length(tag) - 3), F.lit(_ATTRIBUTE), F.lit(0))

    def wanted(attribute: Column) -> Column:
        name = F.lower(F.regexp_extract(attribute, _ATTRIBUTE, 1))
        return (name == "href") | (foreign & (name == "xlink:href"))

    any_place = _let(
        F.get(F.filter(attributes, wanted), F.lit(0)), lambda found: F.concat(*[F.regexp_extract(found, _ATTRIBUTE, n) for n in (2, 3, 4)])
    )
    first = r'^<[aA]\s+[hH][rR][eE][fF]="([^"]*)"'
    return decoded_references(F.when(tag.rlike(first), F.regexp_extract(tag, first, 1)).otherwise(any_place), attribute=True)


def _counting(tags: Column, wanted: str, value) -> Column:
    """``value(tag, foreign)`` of the tags of a name that count: not those in a template or a list of choices."""
    start = F.struct(
        F.lit(0).alias("hidden"), F.lit(0).alias("foreign"), F.lit(False).alias("choices"), F.array().cast("array<string>").alias("found")
    )

    def read(s: Column, tag: Column) -> Column:
        name = F.lower(F.regexp_extract(tag, r"^<(/?[a-zA-Z]+)", 1))

        def depth(old: Column, *names: str) -> Column:
            return F.when(name.isin(*names), old + 1).when(name.isin(*[f"/{n}" for n in names]), F.greatest(old - 1, F.lit(0))).otherwise(old)

        choices = F.when(name == "select", ~s["choices"]).when(name.isin("/select", *_ENDS_SELECT.split("|")), False).otherwise(s["choices"])
        counts = (name == wanted) & (s["hidden"] == 0) & ~s["choices"]
        return F.struct(
            depth(s["hidden"], "template").alias("hidden"), depth(s["foreign"], "svg", "math").alias("foreign"), choices.alias("choices"),
            F.when(counts, F.concat(s["found"], F.array(value(tag, s["foreign"] > 0)))).otherwise(s["found"]).alias("found"),
        )

    deciding = rf"(?i)^</?(?:{_DECIDING}){_NAME_ENDS}"
    plain = F.transform(F.filter(tags, lambda t: t.rlike(rf"(?i)^<{wanted}{_NAME_ENDS}")), lambda t: value(t, F.lit(False)))
    return F.when(F.exists(tags, lambda t: t.rlike(deciding)), F.aggregate(tags, start, read, lambda s: s["found"])).otherwise(plain)


def title_of(tags: Column) -> Column:
    """Content of the first title that has any; NULL without one."""
    contents = _counting(tags, "title", lambda tag, _: _content(tag))
    return _let(F.get(F.filter(contents, lambda t: t != ""), F.lit(0)), lambda t: decoded_references(t))


def hrefs_of(tags: Column) -> Column:
    """Targets of the links in order; in foreign content ``xlink:href`` is one, too."""
    return F.filter(_counting(tags, "a", _href), lambda h: h.isNotNull())
