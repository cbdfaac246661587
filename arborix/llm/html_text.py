"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and URL path; each is paired with the neighbour in its host whose path shares
the longer prefix (the one before on a tie). The lines (blocks) of both are aligned by longest common
subsequence, and shared lines are deleted as template. Lines inside a page's article are
content whatever its neighbour has, so a copy of an article isn't deleted for being shared; lines
of menus, notices and the like are never content, so a menu that differs from page to page goes too.
In an article a block whose class or id only holds such a word (`review-body`, `related-work`) is left to
the alignment; one that is named so as a whole (`comments`, `share-buttons`) is never content.
"""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_parts

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
#: The rest of a tag: quotes hold a value only after an equals sign, and what meets another < first is no tag. Nothing is tried twice.
_REST = re.compile(r"""((?:[^<>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|)|["'])*+)>""")
_RAW = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style noscript template textarea title svg iframe select canvas audio video".split()}
_BLOCK = set("address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
_DROP = set("nav header footer aside form button dialog menu head fieldset label input search".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_NAMES = re.compile(r"(?i)(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|nav\w*|menu|breadcrumbs?|sidebar|side|widget|footer|header|masthead|toolbar|share|sharing|social|related|recommend\w*|comments?|commentlist|disqus|replies|respond|reviews?)(?=$|[\s_-])")
#: A class or id that is such a name as a whole, or with a word for a part of a page: of these blocks nothing is content in an article either.
_PART_NAME = re.compile(r"(?i)(?:^|\s)(?:(?:post|entry|article|site|page|user|reader|main)[_-])?(?:ads?|advert\w*|adsense|banner|promo\w*|sponsor\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscri\w*|signup|login|nav|navbar|navigation|menu|breadcrumbs?|sidebar|widgets?|toolbar|shar(?:e|ing)|social|related|recommend(?:ed|ations)|comments?|commentlist|disqus(?:_thread)?|replies|respond|footer)(?:[_-](?:ads?|area|bar|box|block|buttons?|container|content|form|icons?|items?|links?|lists?|menu|notice|panel|posts?|section|slot|thread|top|bottom|left|right|unit|widget|wrapper|\d+))*(?=$|\s)")
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_ATTR = re.compile(r"""([\w:-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)""")
#: Elements whose names say nothing of what is inside them; in an article headings and words within a paragraph neither.
_ROOTS = {"body", "html"}
_WORDS = _ROOTS | set("h1 h2 h3 h4 h5 h6 p b i em strong span a code pre blockquote figure figcaption td th tr table tbody li".split())
_MARKS = {"<!--": "-->", "<!": ">", "<?": ">"}
_SPACE = re.compile(r"\s+")
SCHEMA = "page_id long, url string, text string, n_chars long, n_shared int, neighbour long"


def lines_of(page: str) -> tuple[list[str], np.ndarray]:
    """The blocks of a page, and for each 1 inside an article, -1 inside what is never content, else 0."""
    out: list[str] = []
    kinds: list[int] = []
    held: list[str] = []
    stack: list[tuple[str, int, int]] = []  # name, kind inside it, kind outside
    open_names: Counter = Counter()
    kind, pos, n = 0, 0, len(page)

    def flush() -> None:
        if held:
            line = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if line:
                out.append(line)
                kinds.append(kind)

    def close(k: int) -> None:
        open_names.subtract(x[0] for x in stack[k:])
        del stack[k:]

    while pos < n:
        at = page.find("<", pos)
        if at != pos:
            held.append(page[pos : at if at >= 0 else n])
        if at < 0:
            break
        mark = _MARKS.get(page[at : at + 4]) or _MARKS.get(page[at : at + 2])
        if mark:  # a comment, CDATA, a declaration or an instruction
            cdata = page.startswith("<![CDATA[", at)
            end = page.find("]]>" if cdata else mark, at + (9 if cdata else len(mark) - 1))
            if cdata:
                held.append(html.escape(page[at + 9 : end if end >= 0 else n]))
            pos = end + (3 if cdata else len(mark)) if end >= 0 else n
            continue
        m = _NAME.match(page, at)
        rest = _REST.match(page, m.end()) if m else None
        if rest is None:  # a bare <
            held.append("<")
            pos = at + 1
            continue
        pos = rest.end()
        name, own = m[2].lower(), rest[1]
        if m[1]:
            if name in _BLOCK:
                flush()
            if not open_names[name]:
                continue
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in _BLOCK and stack[k][1] != stack[k][2]:
                        flush()
                    kind = stack[k][2]
                    close(k)
                    break
            continue
        if name in _RAW:
            if not own.endswith("/"):
                end = _RAW[name].search(page, pos)
                pos = end.end() if end else n
            continue
        attributes = {k.lower(): v[1:-1] if v[0] in "\"'" else v for k, v in _ATTR.findall(own)} if "=" in own else {}
        inside = kind
        if kind >= 0:
            label = f"{attributes.get('class', '')} {attributes.get('id', '')}"
            if name in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"):
                inside = 1
            elif name in _DROP and not (kind == 1 and name == "header") or attributes.get("role", "").lower() in _ROLES or (name not in (_WORDS if kind else _ROOTS) and label.strip() and (_PART_NAME if kind else _NAMES).search(label)) or re.search(r"(?:^|\s)hidden(?=$|[\s/=])(?!\s*=\s*[\"']?until)", own) or attributes.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "")):
                inside = -1
            elif kind == 1 and name not in _WORDS and label.strip() and _NAMES.search(label):
                inside = 0  # the name may say what it is about: the neighbour tells
        if name in _BLOCK or inside != kind:
            flush()
        if name == "p" and open_names["p"]:  # a paragraph ends the one before
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    kind = stack[k][2]
                    inside = min(inside, kind) if inside == -1 else kind
                    close(k)
                    break
                if stack[k][0] in _BLOCK:
                    break
        if name not in _VOID and not own.endswith("/"):
            stack.append((name, inside, kind))
            open_names[name] += 1
            kind = inside
    flush()
    return out, np.array(kinds, np.int8)


def _rows(a: list, b: list) -> tuple[list[int], int]:
    """Bit vectors of the lengths of longest common subsequences of a's beginnings (one each, from none on) and b: bit j is unset where b[j] makes it longer."""
    at: dict = {}
    for j, x in enumerate(b):
        at[x] = at.get(x, 0) | 1 << j
    full = (1 << len(b)) - 1
    v, out = full, [full]
    for x in a:
        u = v & at.get(x, 0)
        v = (v + u | v - u) & full
        out.append(v)
    return out, full


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of a longest common subsequence of a and each beginning of b."""
    v = _rows(a, b)[0][-1].to_bytes(len(b) // 8 + 1, "little")
    return np.concatenate(([0], np.cumsum(1 - np.unpackbits(np.frombuffer(v, np.uint8), bitorder="little")[: len(b)].astype(np.int64))))


def shared(a: list, b: list, most_bits: int = 1 << 29) -> np.ndarray:
    """Which of a lie on a longest common subsequence of a and b.

    Common ends are taken off; then whole rows are computed at once as bits, and larger tables are halved, so that memory is bounded."""
    hit = np.zeros(len(a), bool)
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    ea, eb = len(a), len(b)
    while ea > lo and eb > lo and a[ea - 1] == b[eb - 1]:
        ea, eb = ea - 1, eb - 1
    hit[:lo], hit[ea:] = True, True
    x, y = a[lo:ea], b[lo:eb]
    if not x or not y:
        return hit
    if len(x) * len(y) > most_bits and len(x) > 1:
        half = len(x) // 2
        whole = _lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]
        cut = int(whole.argmax())
        hit[lo:ea] = np.concatenate((shared(x[:half], y[:cut], most_bits), shared(x[half:], y[cut:], most_bits)))
        return hit
    rows = [v.to_bytes(len(y) // 8 + 1, "little") for v in _rows(x, y)[0]]
    longer = lambda i, j: not rows[i][j >> 3] >> (j & 7) & 1
    i, j = len(x), len(y) - 1
    while i and j >= 0:
        if not longer(i, j):
            j -= 1
        elif longer(i - 1, j):
            i -= 1
        else:
            i, j = i - 1, j - 1
            hit[lo + i] = True
    return hit


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


class _Page:
    __slots__ = ("host", "path", "page_id", "url", "lines", "kinds", "hashes", "halo")

    def __init__(self, host, path, page_id, url, page, halo):
        self.host, self.path, self.page_id, self.url, self.halo = host, path, page_id, url, halo
        self.lines, self.kinds = lines_of(page or "")
        self.hashes = [zlib.crc32(x.encode("utf-8", "replace")) << 32 | len(x) for x in self.lines]

    def row(self, before, after):
        near = [x for x in (before, after) if x is not None and x.host == self.host]
        other = max(near, key=lambda x: _common(x.path, self.path), default=None)
        same = shared(self.hashes, other.hashes) if other else np.zeros(len(self.lines), bool)
        keep = (self.kinds == 1) | ((self.kinds == 0) & ~same)
        text = "\n".join(x for x, k in zip(self.lines, keep.tolist(), strict=True) if k)
        return self.page_id, self.url, text, len(text), int(same.sum()), other.page_id if other else None


def _difference(batches):
    """Rows in order of host, path and page_id; those with halo are other ranges' edge pages, and only neighbours here."""
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int64()]
    names = ["page_id", "url", "text", "n_chars", "n_shared", "neighbour"]
    before = now = None
    part = None
    rows: list[tuple] = []

    def out():
        batch = pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)
        rows.clear()
        return batch

    for batch in batches:
        for r in batch.to_pylist():
            page = _Page(r["host"], r["path"], r["page_id"], r["url"], r["html"], r["halo"])
            if r["part"] != part:  # another range starts
                if now is not None and not now.halo:
                    rows.append(now.row(before, None))
                before = now = None
                part = r["part"]
            if now is not None and not now.halo:
                rows.append(now.row(before, page))
            before, now = now, page
        if rows:
            yield out()
    if now is not None and not now.halo:
        rows.append(now.row(before, None))
        yield out()


def extract(pages: DataFrame, sample: int = 20_000) -> DataFrame:
    """(page_id, url, text, n_chars, n_shared, neighbour) of every row (page_id, url, html).

    A null html has no text, a null url stands in a host of its own together with other null urls; repeated
    rows are neighbours of each other; ties in the order go by page_id, then by the html's hash; an empty
    table gives no row. The ranges' bounds come from `sample` keys at most, and each range's edge pages are
    given to the ranges beside it, so the result doesn't depend on the bounds."""
    spark = pages.sparkSession
    url = F.coalesce("url", F.lit(""))
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    rows = pages.select("page_id", "url", "html", F.regexp_extract(rest, r"^[^/?#]*", 0).alias("host"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"))
    key = F.struct("host", "path", F.coalesce("page_id", F.lit(-1)).alias("id"), F.xxhash64("html").alias("h"))
    keys = rows.select(F.struct("host", "path", F.coalesce("page_id", F.lit(-1)).alias("id")).alias("k"), F.xxhash64("page_id").alias("o"))
    parts = n_parts(spark)
    picked = sorted(tuple(r["k"]) for r in keys.orderBy("o").limit(sample).collect())
    cuts = sorted({picked[i * len(picked) // parts] for i in range(1, parts)} if picked else set())
    short = F.struct("host", "path", F.coalesce("page_id", F.lit(-1)).alias("id"))
    if cuts:
        bounds = F.array(*[F.struct(F.lit(a).alias("host"), F.lit(b).alias("path"), F.lit(c).cast("long").alias("id")) for a, b, c in cuts])
        part = _rank(short, bounds, len(cuts))
    else:
        part = F.lit(0)
    rows = rows.withColumn("part", part).withColumn("key", key)
    body = F.struct("page_id", "url", "html", "host", "path", "key")
    edges = rows.groupBy("part").agg(F.min_by(body, "key").alias("first"), F.max_by(body, "key").alias("last"))  # two pages for each range
    # a range without rows passes its neighbours' edges on; there is none here, as every bound is a row's key
    halo = edges.select((F.col("part") - 1).alias("part"), "first.*").unionByName(edges.select((F.col("part") + 1).alias("part"), "last.*")).withColumn("halo", F.lit(True))
    both = rows.withColumn("halo", F.lit(False)).unionByName(halo)
    # a range is a task of its own, bounded by its share of the keys
    dealt = both.where(F.col("part").between(0, len(cuts))).repartitionById(len(cuts) + 1, F.col("part").cast("int")).sortWithinPartitions("part", "key")
    return dealt.select("part", "host", "path", "page_id", "url", "html", "halo").mapInArrow(_difference, SCHEMA)


def _rank(key, bounds, n: int):
    """How many of the n sorted bounds are not above the key, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= n) & (F.get(bounds, low + step - 1) <= key), low + step).otherwise(low))
