"""Popup triggers, reference lists and item texts of a page, from one parse, as a table function (PARSE-14, 15, 19, 26, 27, 29, 31 to 33)."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.package import ship
from .html_nodes import Element, parse

#: What hints at a popup, what is a control of the page itself, and how calls of popups look.
HINT = re.compile(r"javascript:|void\s*\(|onclick|glossary|definition|popover|tooltip|(?:^|\/)mcm|context|dlg|dialog|modal|popup", re.I)
CONTROL = re.compile(r"expand\s*all|collapse\s*all|print\s+view|benchmark\s|return\s+to\s+top|link\s+to\s+codes|show\s+all\s+code", re.I)
DEFINITION = re.compile(r"""popup_definition\s*\(\s*(['"])(?P<id>[^'"]*)\1\s*,\s*(['"])(?P<title>[^'"]*)\3\s*\)""", re.I)
CALL = re.compile(r"\b(popup_[a-z0-9_]+)\s*\(", re.I)
OWN_CALLS = ("popup_definition", "popup_citation", "popup_footnote")
CLICKABLE = ("span", "font", "button", "td")

#: Strings, brackets and commas of a call; a quote that opens no string ends the scan.
_TOKEN = re.compile(r"""'(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*"|[()'",]""", re.S)


def arguments(source: str | None, callee: str) -> list[str] | None:
    """PARSE-33: the arguments of the first closed call of callee, at commas outside strings and inner brackets; None without one.

    Arguments that are strings lose quotes and backslashes, others stay as they are; empty ones are left out."""
    source = source or ""
    for call in re.finditer(re.escape(callee) + r"\(", source, re.I) if callee else ():
        depth, start, found = 0, call.end(), []
        for token in _TOKEN.finditer(source, call.end() - 1):
            c = token[0]
            if c in ("'", '"'):
                break
            depth += (c == "(") - (c == ")")
            if c == "," and depth == 1 or not depth:
                found.append(source[start : token.start()].strip())
                start = token.end()
            if not depth:
                return [_plain(x) for x in found if x]
    return None


def _plain(x: str) -> str:
    return re.sub(r"\\(.?)", r"\1", x[1:-1], flags=re.S) if len(x) > 1 and x[0] in "'\"" and x[-1] == x[0] else x


def classify(onclick: str | None) -> tuple[str, str, list[str] | None]:
    """PARSE-32: type, handler and arguments of a popup call: definition, citation, footnote, context, then any other."""
    onclick = onclick or ""
    if m := DEFINITION.search(onclick):
        return "definition", "popup_definition", [m["id"], m["title"]]
    for kind in ("citation", "footnote"):
        if re.search(rf"popup_{kind}\s*\(", onclick, re.I):
            return kind, f"popup_{kind}", arguments(onclick, f"popup_{kind}")
    heads = [m[1] for m in CALL.finditer(onclick) if m[1].lower() not in OWN_CALLS]
    for name in ("popup_context", "popup_mcm_context", *(x for x in heads if "context" in x.lower()[6:])):
        if (found := arguments(onclick, name)) is not None:
            return "context", name, found
    return ("other_popup", heads[0], arguments(onclick, heads[0])) if heads else ("other_popup", "", None)


def _pieces(e: Element, drop) -> str:
    """The texts below e, each trimmed, with spaces between; what `drop` holds for is left out with all below it."""
    out, stack = [], list(reversed(e.children))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x)
        elif x.name not in ("script", "style") and not drop(x):
            stack += reversed(x.children)
    return " ".join(" ".join(out).split())


def _attribute(e: Element, name: str) -> str:
    return e.attributes.get(name) or ""


def triggers(top: Element):
    """PARSE-29: (tag, text, href, onclick, class, id, title, data keys) of what looks like a popup's trigger, each key of five cut fields once."""
    seen = set()
    for e in top.all():
        if not (e.name == "a" or e.attributes.get("role") == "link" or e.name in CLICKABLE and "onclick" in e.attributes):
            continue
        text = _pieces(e, lambda x: False).lower()
        href, onclick, own_id = (_attribute(e, k) for k in ("href", "onclick", "id"))
        kinds, title = " ".join(_attribute(e, "class").split()), _attribute(e, "title") or _attribute(e, "aria-label")
        if CONTROL.search(text) or CONTROL.search(title.lower()):
            continue
        data = sorted(k for k in e.attributes if k.startswith("data-"))
        hinted = HINT.search(html.unescape(" ".join((onclick, href, kinds, own_id, title))))
        if not (onclick.strip() or hinted or data or HINT.search(href) or HINT.search(html.unescape(title))):
            continue
        if e.name == "button" and "expand" in text and not hinted:
            continue
        key = "|".join((text[:120], href[:200], onclick[:240], kinds[:240], own_id[:120]))
        if key not in seen:
            seen.add(key)
            yield e.name, text[:260], html.unescape(href)[:260], html.unescape(onclick)[:400], html.unescape(kinds)[:260], own_id[:120], html.unescape(title)[:260], data[:12]


def _abstract(e: Element) -> bool:
    return e.name == "a" and bool(re.search("abstract", _attribute(e, "title"), re.I) or re.search("View abstract", _pieces(e, lambda x: False), re.I))


def _after(top: Element, title: str):
    """What stands after the h2 of that title, among its siblings."""
    for h in top.all():
        if h.name == "h2" and _pieces(h, lambda x: False) == title:
            around = [x for x in h.parent.children if isinstance(x, Element)]
            return around[next(k for k, x in enumerate(around) if x is h) + 1 :]
    return []


def references(top: Element):
    """PARSE-26: (number, text, DOI, context links) of the first ordered list under References."""
    for e in _after(top, "References"):
        if e.name in ("h2", "h3"):
            return
        if e.name == "ol":
            for k, li in enumerate((x for x in e.children if isinstance(x, Element) and x.name == "li"), 1):
                text = _pieces(li, _abstract)
                doi, links = re.search(r"DOI:\s*(\S+)", text, re.I), re.search(r"\[\s*Context Link\s*([^\]]+)\]", text, re.I)
                yield str(k), text, doi[1].rstrip(".") if doi else None, [x.strip() for x in links[1].split(",") if x.strip()] if links else []
            return


def footnotes(top: Element):
    """PARSE-27: (key, text, references) of the footnote paragraphs; a key's first one counts, those without a key don't."""
    seen = set()
    for e in _after(top, "Footnotes"):
        if e.name == "h2":
            return
        if e.name == "p" and "MsoFootnoteText" in _attribute(e, "class"):
            m = re.match(r"\[\s*([A-Z0-9]+)\s*\]\s*(.*)$", _pieces(e, lambda x: False), re.S)
            if m and m[1] not in seen:
                seen.add(m[1])
                yield m[1], m[2], re.findall(r"\((\d+)\)", m[2])


def _unseen(e: Element) -> bool:
    """PARSE-14, PARSE-15: inner lists, collapsed halves, their controls, images and annotation links."""
    onclick, title = _attribute(e, "onclick"), _attribute(e, "title")
    if e.name == "a":
        return bool(re.search(r"\b(collapse|expand)\s*\(|popup_annotation", onclick, re.I)) or "annotation" in title.lower() or "Supporting evidence" in title
    return e.name in ("ul", "img") or e.name == "div" and _attribute(e, "id").startswith("c-")


def item_text(li: Element) -> str:
    """PARSE-13 to PARSE-15: what an item shows: its expanded half, without what belongs to inner items."""
    return _pieces(li, _unseen)


class PageParts:
    """A table function: all triggers, references, footnotes and items of one page, from one parse."""

    def eval(self, page: str):
        top, n = parse(page or ""), 0
        for tag, text, href, onclick, kinds, own_id, title, data in triggers(top):
            kind, handler, found = classify(onclick)
            yield "trigger", n, tag, text, href, onclick, kinds, own_id, title, data, kind, handler, found
            n += 1
        blank = (None,) * 3
        for number, text, doi, links in references(top):
            yield "reference", n, number, text, doi, None, None, None, None, links, *blank
            n += 1
        for key, text, refs in footnotes(top):
            yield "footnote", n, key, text, None, None, None, None, None, refs, *blank
            n += 1
        for li in (e for e in top.all() if e.name == "li"):
            yield "item", n, li.name, item_text(li), None, None, None, None, None, None, *blank
            n += 1


PARTS = "part string, nth int, name string, text string, href string, onclick string, class string, id string, title string, list array<string>, popup_type string, handler string, args array<string>"


def page_parts(pages: DataFrame, page: str = "html") -> DataFrame:
    """The columns of pages beside the parts of each page, by a lateral join with the table function; null html has no part.

    Of a trigger `name` is the tag and `list` its data attributes; of a reference `name` is its number, `href` its DOI and `list` its context
    links; of a footnote `name` is its key and `list` the references it names."""
    ship(pages.sparkSession)
    return pages.lateralJoin(F.udtf(PageParts, returnType=PARTS)(F.col(page).outer()))


def popup_title(text: Column, kind: Column) -> Column:
    """PARSE-31: a popup's title by its type, from its lines that hold something, cut to 400 characters."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\x0C\x85  ]"), lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^ | $", "")), lambda x: x != "")
    first = lambda n, test: F.get(F.filter(F.slice(lines, 1, n), test), F.lit(0))
    top = F.get(lines, F.lit(0))
    named, headed = first(12, lambda x: x.rlike(r"(?i)^Definition\b")), first(12, lambda x: (F.length(x) >= 12) & x.contains(":") & (F.length(x) <= 200))
    said = F.when(kind == "definition", F.coalesce(named, headed, top)).when(kind.isin("citation", "footnote"), F.coalesce(first(8, lambda x: x.rlike("[0-9A-Za-z]")), top))
    said = said.when(kind == "context", F.coalesce(first(10, lambda x: F.lower(x).contains("context") | F.lower(x).contains("link")), top)).otherwise(top)
    default = F.when(kind == "definition", "Definition").otherwise(F.initcap(F.replace(kind, F.lit("_"), F.lit(" "))))
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.substring(F.coalesce(said, default), 1, 400))


def expand_groups(siblings: DataFrame, by: list[str], place: str, markup: str, out: str, most: int = 30) -> DataFrame:
    """PARSE-19: the group that the nearest of at most `most` siblings before expands, null if none does; texts count as siblings."""
    own = F.regexp_extract(markup, r"(?i)expandall\('([^']+)'\)", 1)
    return siblings.withColumn(out, F.last(F.when(own != "", own), True).over(Window.partitionBy(*by).orderBy(place).rowsBetween(-most, -1)))
