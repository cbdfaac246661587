"""HTML to typed records in one parse for each page (PARSE-*): sections, list nodes, links, metas and table cells as one tagged table.

The tree builder is html.parser's; unlike a repairing parser it only closes open p and li elements when
a sibling starts, and ignores end tags that match nothing."""

from __future__ import annotations

import hashlib
import re
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "page_id long, kind string, ord int, id string, parent string, depth int, name string, text string, path string, text_hash string"
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol"}, "td": {"tr"}, "th": {"tr"}, "tr": {"table"}, "p": {"div", "article", "section", "body", "li", "td", "b"}}


class Element:
    __slots__ = ("name", "attributes", "children", "parent", "place")

    def __init__(self, name: str, attributes: dict, parent: Element | None):
        self.name, self.attributes, self.children, self.parent, self.place = name, attributes, [], parent, None

    def all(self):
        stack = [self]
        while stack:
            e = stack.pop()
            yield e
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]

    def text(self, skip: frozenset = frozenset({"script", "style"}), between: str = "") -> str:
        """The texts below, with what stands between two of them; white space becomes one space."""
        out: list[str] = []
        stack: list = [self]
        while stack:
            e = stack.pop()
            if isinstance(e, str):
                out.append(e)
            elif e.name not in skip or e is self:
                stack += reversed(e.children)
        return " ".join(between.join(out).split())

    def path(self) -> str:
        """PARSE-21: tag[n] among siblings of one name, from the top."""
        parts, e = [], self
        while e.parent is not None:
            if e.place is None:  # the parent's children are numbered once
                seen: dict[str, int] = {}
                for c in e.parent.children:
                    if isinstance(c, Element):
                        c.place = seen[c.name] = seen.get(c.name, 0) + 1
            parts.append(f"{e.name}[{e.place}]")
            e = e.parent
        return "/".join(reversed(parts))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = self.now = Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in _CLOSES:
            e = self.now
            while e.parent is not None and e.name not in _STOPS.get(tag, ()):
                if e.name in _CLOSES[tag]:
                    self.now = e.parent
                    break
                e = e.parent
        e = Element(tag, dict(attrs), self.now)
        self.now.children.append(e)
        if tag not in _VOID:
            self.now = e

    def handle_startendtag(self, tag, attrs):
        self.now.children.append(Element(tag, dict(attrs), self.now))

    def handle_endtag(self, tag):
        e = self.now
        while e.parent is not None and e.name != tag:
            e = e.parent
        if e.parent is not None:
            self.now = e.parent

    def handle_data(self, data):
        self.now.children.append(data)


def parse(page: str) -> Element:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.top


_REFERENCE = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


def whole_references(page: str) -> str:
    """The page in which only character references that have their semicolon are read as such; others, such as those that a cut left, mean themselves."""
    return _REFERENCE.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else f"&amp;{m[1] or ''}", page)


def records(page: str, whole: bool = False) -> list[tuple]:
    """(kind, ord, id, parent, depth, name, text, path) of a page; with `whole`, references without a semicolon stay as they are written."""
    top = parse(whole_references(page) if whole else page)
    out: list[tuple] = []
    order = 0

    def put(*row) -> None:
        nonlocal order
        out.append((row[0], order, *row[1:]))
        order += 1

    meta: dict[str, str] = {}
    section = "s000"
    n_sections = 0
    for e in top.all():
        if e.name == "meta" and e.attributes.get("name"):
            meta[e.attributes["name"]] = e.attributes.get("content") or ""  # the later wins (PARSE-2)
        elif e.name == "title":
            put("title", "title", None, 0, "title", e.text(), e.path())
        elif e.name in ("h1", "h2", "h3"):
            n_sections += 1
            section = f"s{n_sections:03d}"
            put("section", section, None, int(e.name[1]), e.name, e.text(), e.path())
        elif e.name == "a" and e.attributes.get("href") is not None:
            put("link", None, section, 0, e.attributes["href"], e.text(), e.path())
        elif e.name == "p" and (text := e.text(between=" ")):  # PARSE-16: words that only markup parts stay apart
            put("paragraph", None, section, 1, "p", text, e.path())
        elif e.name in ("ul", "ol") and not _inside(e, {"li"}):
            for row in _items(e, section):
                put(*row)
        elif e.name == "table":
            for r, tr in enumerate(x for x in e.all() if x.name == "tr"):
                for c, cell in enumerate(x for x in tr.children if isinstance(x, Element) and x.name in ("td", "th")):
                    put("cell", f"{r}.{c}", section, r, cell.name, cell.text(), cell.path())
    for name, content in meta.items():
        put("meta", name, None, 0, name, content, "")
    return out


def _inside(e: Element, names: set) -> bool:
    e = e.parent
    while e is not None:
        if e.name in names:
            return True
        e = e.parent
    return False


def _items(ul: Element, section: str):
    """PARSE-10, PARSE-12: list items in preorder, however deep; an empty item uses its number up and its lists are left out (S12)."""
    open_lists = [[iter(ul.children), "", 1, 0]]  # items left, id above, depth, number
    while open_lists:
        top = open_lists[-1]
        li = next(top[0], None)
        if li is None:
            open_lists.pop()
            continue
        if not isinstance(li, Element) or li.name != "li":
            continue
        top[3] += 1
        prefix, depth = top[1], top[2]
        own = f"{prefix}.{top[3]:03d}" if prefix else f"{section}.{top[3]:03d}"
        text = li.text(frozenset({"ul", "ol", "script", "style", "img"}), " ")
        if not text:
            continue
        yield "item", own, prefix or section, depth, "li", text, li.path()
        below, stack = [], list(reversed(li.children))
        while stack:  # lists of this item, not of items inside them
            e = stack.pop()
            if isinstance(e, Element):
                if e.name in ("ul", "ol"):
                    below.append(e)
                if e.name != "li":
                    stack += reversed(e.children)
        open_lists += [[iter(x.children), own, depth + 1, 0] for x in reversed(below)]


def extract(pages: DataFrame, whole: bool = False) -> DataFrame:
    """All records of all pages (page_id, html); with `whole`, character references without a semicolon stay as they are written."""

    def work(batches):
        kinds = [pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.string()]
        names = ["page_id", "kind", "ord", "id", "parent", "depth", "name", "text", "path", "text_hash"]
        for batch in batches:
            rows = [(p, *r, hashlib.sha256(r[6].encode("utf-8", "replace")).hexdigest()) for p, h in zip(*(batch.column(c).to_pylist() for c in ("page_id", "html")), strict=True) for r in records(h or "", whole)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return pages.select("page_id", "html").mapInArrow(work, SCHEMA)


_CALL = re.compile(r"([A-Za-z_$][\w$]*)\s*\(")


def call_arguments(source: str, function: str | None = None) -> list[str] | None:
    """PARSE-33: arguments of the first call (of the function, if named): split at commas outside quotes and brackets, quotes taken off."""
    for m in _CALL.finditer(source or ""):
        if function and m[1] != function:
            continue
        out, now, depth, quote, i = [], "", 1, "", m.end()
        while i < len(source):
            c = source[i]
            if quote:
                if c == "\\" and i + 1 < len(source):
                    now += source[i : i + 2]
                    i += 2
                    continue
                quote = "" if c == quote else quote
                now += c
            elif c in "\"'":
                quote = c
                now += c
            elif c in "([{":
                depth += 1
                now += c
            elif c in ")]}":
                depth -= 1
                if not depth:
                    out.append(now)
                    return [_unquote(x) for x in out] if "".join(out).strip() else []
                now += c
            elif c == "," and depth == 1:
                out.append(now)
                now = ""
            else:
                now += c
            i += 1
    return None


def _unquote(x: str) -> str:
    x = x.strip()
    return x[1:-1] if len(x) > 1 and x[0] == x[-1] and x[0] in "\"'" else x


def ordered_refs(x, pattern: str):
    """PARSE-23, PARSE-24: captured references, distinct in first-seen order."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(pattern), F.lit(1)))
