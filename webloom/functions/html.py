"""Visible text and language of a page in one vectorised pass.

The scan keeps only a stack of open element names, enough to know where an
element ends when the page leaves that implied. It does not move misplaced
content (text directly inside a table, repeated formatting elements) the way a
browser's full tree builder does.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pyarrow as pa
from pyspark.sql import functions as F

from webloom.functions.text import UNICODE_BLANKS
from webloom.functions.trigrams import best_languages, slices

PAGE_TYPE = "struct<text:string,lang:string>"

# Element groups of the HTML standard.
BREAK_AFTER = {"br", "p", "div", "li"}
VOID = set("area base br col embed frame hr img input link meta param source track wbr".split())
RAW_TEXT = set("script style xmp iframe noembed noframes noscript".split())
RAW_WITH_REFERENCES = {"title", "textarea"}
NOT_VISIBLE = {"script", "style"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
FORMATTING = set("a b big code em font i nobr s small strike strong tt u".split())
ENDS_PARAGRAPH = HEADINGS | set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form header hgroup hr listing main menu nav ol p plaintext pre search section summary ul xmp".split()
)
SPECIAL = ENDS_PARAGRAPH | VOID | RAW_TEXT | set(
    "applet body button caption colgroup dd dt frameset head html li marquee object select table tbody td "
    "template textarea tfoot th thead title tr".split()
)
SCOPE_LIMITS = set("applet caption html marquee object table td template th foreignobject desc".split())
PARAGRAPH_LIMITS = SCOPE_LIMITS | {"button"}
LIST_LIMITS = SCOPE_LIMITS | {"ol", "ul"}
TABLE_PARTS = set("table template tr td th tbody thead tfoot caption".split())
# All that a list of choices may hold; other tags in it are ignored.
SELECT_CONTENT = {"option", "optgroup", "select", "template", "hr"}
ENDS_SELECT = {"input", "keygen", "textarea"}
# An opening tag that ends an open element of the named kind, up to a limit.
IMPLIED_ENDS = {
    "li": ({"li"}, SPECIAL - {"address", "div", "p", "li"}),
    "dd": ({"dd", "dt"}, SPECIAL - {"address", "div", "p", "dd", "dt"}),
    "dt": ({"dd", "dt"}, SPECIAL - {"address", "div", "p", "dd", "dt"}),
    "td": ({"td", "th"}, {"table", "template"}),
    "th": ({"td", "th"}, {"table", "template"}),
    "tr": ({"tr"}, {"table", "template"}),
    "tbody": ({"tbody", "thead", "tfoot"}, {"table", "template"}),
    "thead": ({"tbody", "thead", "tfoot"}, {"table", "template"}),
    "tfoot": ({"tbody", "thead", "tfoot"}, {"table", "template"}),
    "button": ({"button"}, SCOPE_LIMITS),
}
STRUCTURAL = ENDS_PARAGRAPH | IMPLIED_ENDS.keys() | {"html", "head", "body", "table", "option", "optgroup"}
# Inline elements that neither end others nor mean anything here.
WITHOUT_RULES = FORMATTING - {"a", "nobr"} | set("span abbr cite dfn kbd label mark q samp sub sup time var".split())

_INSIDE_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)*+"""
_MARKUP = re.compile(
    r"([^<]+)"
    rf"|<([a-zA-Z][^\s/>]*+)({_INSIDE_TAG})>"
    rf"|</([a-zA-Z][^\s/>]*+){_INSIDE_TAG}>"
    r"|<!--(?:-?>|.*?(?:--!?>|\Z))"  # comment
    r"|<(?:[!?]|/(?=[^a-zA-Z]))[^>]*+(?:>|\Z)"  # doctype and other declarations
    r"|</?[a-zA-Z].*\Z"  # tag cut off by the end of the page
    r"|(<)",
    re.S,
)
_TEXT, _START, _ATTRS, _END, _STRAY = range(1, 6)  # groups of the pattern above


# The first markup, behind blanks and comments: a doctype without a public name (or with a strict one).
_STANDARDS = re.compile(
    r"(?:\s|<!--(?:(?!-->).)*-->)*+<!doctype\s+html\s*(?:>|system\b|public\s+[\"']-//w3c//dtd (?:x?html 4\.01|xhtml 1\.[01])//)",
    re.I | re.S,
)


class PageScan:
    """One pass over a page's markup; results are left in the attributes."""

    def __init__(self, html: str):
        self._pieces: list[str] = []
        self._open: list[str] = []
        self._count: dict[str, int] = defaultdict(int)  # open elements by name, as pages may nest deeply
        self._tables_end_paragraphs = False
        self._scan(html)
        self._close_down_to(0)
        self.text = "".join(self._pieces).strip(UNICODE_BLANKS)

    @property
    def _foreign(self) -> int:
        return self._count["svg"] or self._count["math"]

    def _scan(self, html: str) -> None:
        if "\0" in html or "\r" in html:
            html = html.replace("\0", "").replace("\r", "\n")
        self._tables_end_paragraphs = bool(_STANDARDS.match(html))
        at = 0
        while at is not None:
            at = self._scan_markup(html, at)

    def _scan_markup(self, html: str, at: int) -> int | None:
        """Handle markup up to the next raw content; its end, None when all is read."""
        open_, count, pieces = self._open, self._count, self._pieces
        for found in _MARKUP.finditer(html, at):
            kind = found.lastindex
            if kind == _TEXT or kind == _STRAY:
                if not count["template"]:
                    text = unescape(found[0]) if "&" in found[0] else found[0]
                    pieces.append(text)
            elif kind == _END:
                name = found[_END].lower()
                if open_ and open_[-1] == name:  # most elements end where they should
                    self._close_down_to(len(open_) - 1)
                elif not count["select"] or name in SELECT_CONTENT:
                    self._end(name)
            elif kind == _ATTRS:
                name = found[_START].lower()
                if name in WITHOUT_RULES and not self._foreign:
                    if not count["select"]:
                        open_.append(name)
                        count[name] += 1
                    continue
                if count["select"] and not self._allowed_in_select(name):
                    continue
                if name == "plaintext":
                    self._close_paragraph()
                    pieces.append(html[found.end():])
                    return None
                if name in RAW_TEXT or name in RAW_WITH_REFERENCES and not count["svg"]:
                    return self._raw(html, found.end(), name)
                self._start(name, found[_ATTRS])
        return None

    def _allowed_in_select(self, name: str) -> bool:
        if name in ENDS_SELECT:
            self._close_nearest({"select"}, SCOPE_LIMITS)
            return True
        if name == "select":  # a second one ends the first
            self._close_nearest({"select"}, SCOPE_LIMITS)
            return False
        return name in SELECT_CONTENT or name == "script"

    def _raw(self, html: str, at: int, name: str) -> int:
        """Content up to the matching end tag, in which no other tag counts."""
        end = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(html, at)
        content = html[at : end.start() if end else len(html)]
        if name == "xmp":
            self._close_paragraph()
        if name not in NOT_VISIBLE and content and not self._count["template"]:
            if name in RAW_WITH_REFERENCES:
                content = unescape(content)
            self._pieces.append(content)
        return end.end() if end else len(html)

    def _start(self, name: str, attributes: str) -> None:
        if name in STRUCTURAL:
            if name in ("html", "head", "body"):
                return
            self._end_implied(name)
        foreign = self._foreign
        if name in VOID or (foreign or name in ("svg", "math")) and attributes.endswith("/"):
            self._break_after(name)
        else:
            self._open.append(name)
            self._count[name] += 1

    def _end_implied(self, name: str) -> None:
        """Close what an opening tag of this name ends."""
        if name in IMPLIED_ENDS:
            self._close_nearest(*IMPLIED_ENDS[name])
        if name in ENDS_PARAGRAPH or name in ("li", "dd", "dt") or (
            name == "table" and self._tables_end_paragraphs
        ):
            self._close_paragraph()
        if self._open and (
            name in HEADINGS and self._open[-1] in HEADINGS
            or name in ("option", "optgroup") and self._open[-1] == "option"
        ):
            self._close_down_to(len(self._open) - 1)

    def _end(self, name: str) -> None:
        if name == "br":
            self._break_after("br")
        elif name == "p":
            if not self._close_paragraph():
                self._break_after("p")
        elif name in ("html", "body"):
            return
        elif name in HEADINGS:
            self._close_nearest(HEADINGS, SCOPE_LIMITS)
        elif name in FORMATTING:
            at = self._nearest({name}, SCOPE_LIMITS)
            if at is not None:
                del self._open[at]
                self._count[name] -= 1
        elif name == "li":
            self._close_nearest({name}, LIST_LIMITS)
        elif name in TABLE_PARTS:
            self._close_nearest({name}, {"table", "template"} - {name})
        elif name in SPECIAL:
            self._close_nearest({name}, SCOPE_LIMITS - {name})
        else:
            self._close_nearest({name}, SPECIAL - {name})

    def _nearest(self, names: set[str], limits: set[str]) -> int | None:
        for name in names:
            if self._count[name]:
                break
        else:
            return None
        for at in range(len(self._open) - 1, -1, -1):
            if self._open[at] in names:
                return at
            if self._open[at] in limits:
                return None
        return None

    def _close_nearest(self, names: set[str], limits: set[str]) -> bool:
        at = self._nearest(names, limits)
        if at is not None:
            self._close_down_to(at)
        return at is not None

    def _close_paragraph(self) -> bool:
        return self._count["p"] > 0 and self._close_nearest({"p"}, PARAGRAPH_LIMITS)

    def _close_down_to(self, at: int) -> None:
        while len(self._open) > at:
            name = self._open.pop()
            self._count[name] -= 1
            if name in BREAK_AFTER:
                self._break_after(name)

    def _break_after(self, name: str) -> None:
        if name in BREAK_AFTER and not self._count["template"]:
            self._pieces.append("\n")


def page_udf(model=None):
    """Arrow UDF ``html -> PAGE_TYPE``; with a language model it also labels the text.

    Marked non-deterministic so that the optimizer never runs it a second time for a
    filter on one of its fields. Pages are taken out of a batch a few at a time and their scans are not kept, so that a
    worker holds the batch, its texts and little else.
    """

    @F.arrow_udf(PAGE_TYPE)
    def parse(html: pa.Array) -> pa.Array:
        parsed = []
        for pages in slices(html):
            texts = [PageScan(page).text or None if page else None for page in pages]
            langs = best_languages(texts, model) if model else [None] * len(texts)
            missing = pa.array([not page for page in pages], pa.bool_())
            parsed.append(
                pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(langs, pa.string())], ["text", "lang"], mask=missing)
            )
        return pa.concat_arrays(parsed) if parsed else pa.array([], pa.struct([("text", pa.string()), ("lang", pa.string())]))

    return parse.asNondeterministic()
