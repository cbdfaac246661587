"""Lines in order, codes near words, and patterns that are columns (FN-21, FN-26, FN-32), Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LINES = r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85  ]"


def lines_in_order(text: Column, prefixes: Column) -> Column:
    """FN-32: struct of `taken`, the first trimmed lines that start with the prefixes one after the other, and `missing`, the first prefix without one (else null)."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), _LINES), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    start = F.struct(F.lit(0).alias("n"), F.array().cast("array<string>").alias("taken"))
    step = lambda a, x: F.when(F.coalesce(F.startswith(x, F.get(prefixes, a["n"])), F.lit(False)), F.struct((a["n"] + 1).alias("n"), F.concat(a["taken"], F.array(x)).alias("taken"))).otherwise(a)
    return F.aggregate(lines, start, step, lambda a: F.struct(a["taken"].alias("taken"), F.get(prefixes, a["n"]).alias("missing")))


def quoted(x: Column) -> Column:
    """A value as a pattern that means itself."""
    return F.regexp_replace(x, r"([^A-Za-z0-9\s])", r"\\$1")


def _digits(code: Column) -> Column:
    return F.regexp_extract(F.coalesce(code, F.lit("")), r"(?i)^M(\d+)$", 1)


def _short(digits: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit("")), F.lit("0"))


#: The characters whose upper case is longer than they are, such as ß.
LONGER = r"[\u00DF\u0149\u01F0\u0390\u03B0\u0587\u1E96-\u1E9A\u1F50\u1F52\u1F54\u1F56\u1F80-\u1FAF\u1FB2-\u1FB4\u1FB6-\u1FB7\u1FBC\u1FC2-\u1FC4\u1FC6-\u1FC7\u1FCC\u1FD2-\u1FD3\u1FD6-\u1FD7\u1FE2-\u1FE4\u1FE6-\u1FE7\u1FF2-\u1FF4\u1FF6-\u1FF7\u1FFC\uFB00-\uFB06\uFB13-\uFB17]"


def upper_in_place(x: Column) -> Column:
    """Upper case in which every character keeps its place: one whose upper case is longer becomes U+FFFF, which is in no word."""
    return F.upper(F.regexp_replace(x, LONGER, "\uffff"))


def word_near_code(body: Column, code: Column, word: str = "ORG") -> Column:
    """FN-21: whether the word stands near a mention of the code (M and digits).

    Near a mention in any form of a code of three digits or more: from 48 characters before its start to 24 after; near the first place of one
    of four spellings: from 40 characters before to 20 after its end. Characters are those of the body as it stands, also where upper
    case has more of them. Nulls and other codes are not near anything."""
    digits = _digits(code)
    n, w = _short(digits), len(word)
    mention = F.concat(F.lit(r"(?<![A-Za-z0-9])M\s*-?\s*0*"), n, F.lit(r"(?!\d)"))
    before, after = F.concat(F.lit(rf"(?s){word}.{{0,{48 - w}}}"), mention), F.concat(F.lit(rf"(?s)(?=.{{0,{24 - w}}}{word})"), mention)
    normal = (digits == F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n)) & (F.length(n) <= 5)

    def near(upper: Column) -> Column:
        found = normal & (F.rlike(upper, before) | F.rlike(upper, after))
        for spelling in (F.upper(code), F.concat(F.lit("M-"), digits), F.concat(F.lit("M-"), n), digits):
            at = F.position(spelling, upper)
            first = F.greatest(F.lit(1), at - 40)
            found = found | ((at > 0) & F.substr(upper, first, at + F.length(spelling) + 20 - first).contains(word))
        return F.coalesce((digits != "") & upper.contains(word) & found, F.lit(False))

    return F.get(F.transform(F.array(upper_in_place(F.coalesce(body, F.lit("")))), near), F.lit(0))  # the upper case is made once


def code_markers(text: Column, code: Column) -> Column:
    """FN-26: what of the code the text holds, in order: `ORG: M-` and `M token` forms with the digits as written and without zeros, and the code itself."""
    t, code = F.coalesce(text, F.lit("")), F.upper(F.regexp_replace(F.coalesce(code, F.lit("")), r"(?U)^\s+|\s+$", ""))
    digits, found = _digits(code), []
    for v in (digits, _short(digits)):
        found += [F.when((digits != "") & F.rlike(t, F.concat(F.lit(head), v, F.lit(r"\b"))), F.concat(F.lit(name), v)) for head, name in ((r"(?i)ORG:\s*M-?\s*", "ORG: M-"), (r"(?i)\bM-?\s*", "M token "))]
    literal = F.when((code != "") & F.replace(F.upper(t), F.lit(" "), F.lit("")).contains(code), F.concat(F.lit("literal "), code))
    return F.array_compact(F.array(*found, literal))


def title_within(text: Column, title: Column) -> Column:
    """FN-26: the title where the text holds it, white space and then dashes made equal; else null."""
    flat = lambda x: F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "), "^ | $", "")
    dashed = lambda x: F.regexp_replace(x, "[–—]", "-")
    t, b = flat(title), flat(text)
    return F.when(t == "", None).when(b.contains(t), t).when(dashed(b).contains(dashed(t)), dashed(t))


def page_markers(text: Column, code: Column, title: Column, phrases: list[str]) -> Column:
    """FN-26: struct of `markers` and whether the text holds code, title and one of the phrases (`complete`)."""
    codes, name = code_markers(text, code), title_within(text, title)
    phrase = F.coalesce(*(F.when(F.coalesce(text, F.lit("")).contains(p), F.lit(f"section:{p[:64]}")) for p in phrases))
    markers = F.concat(codes, F.array_compact(F.array(F.concat(F.lit("title:"), F.substring(name, 1, 80)), phrase)))
    return F.struct(markers.alias("markers"), ((F.size(codes) > 0) & name.isNotNull() & phrase.isNotNull()).alias("complete"))
