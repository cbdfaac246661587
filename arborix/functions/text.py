"""Text functions, Column to Column (FN-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def collapse(x: Column) -> Column:
    """FN-1: runs of Unicode white space become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def strip_marks(x: Column) -> Column:
    """FN-2: without one-letter brackets and without `(digit...` up to its `)`, which stays (S25)."""
    y = F.regexp_replace(F.regexp_replace(F.coalesce(x, F.lit("")), r"\[\s*[A-Za-z]\s*\]", ""), r"\(\s*\d[^\)]*", "")
    return F.btrim(collapse(y), F.lit(" :"))


def headline(x: Column) -> Column:
    """FN-3."""
    return collapse(F.lower(strip_marks(x)))


def for_hash(x: Column) -> Column:
    """FN-22."""
    return F.lower(collapse(x))


def slug(x: Column, default: str = "untitled", most: int = 120) -> Column:
    """FN-23."""
    y = F.regexp_replace(for_hash(x), r"^definition\s*-\s*", "")
    y = F.regexp_replace(F.regexp_replace(y, r"[^a-z0-9]+", "_"), r"^_+|_+$", "")
    return F.coalesce(F.nullif(F.substring(y, 1, most), F.lit("")), F.lit(default))


#: Phrase, operator, confidence, kind and pattern of each logic hint, in order of precedence (FN-4, S7).
HINTS = (
    ("1 or more of the following", "OR", "high", "", r"\b(1|one) or more of the following\b"),
    ("all of the following", "AND", "high", "", r"\ball of the following\b"),
    ("examples include or eg", "EXAMPLE_SET", "medium", "example_only", r"examples include|\beg,\b| e\.g\."),
    ("may include", "OPTIONS", "medium", "", r"may include"),
    ("includes", "CHECKLIST", "medium", "", r"\bincludes\b"),
    ("as indicated by", "criteria_intro", "medium", "", r"as indicated by"),
)


def logic_hint(x: Column) -> Column:
    """FN-4: struct of phrase, operator, confidence and kind of the first hint that matches, else null."""
    low = F.lower(F.coalesce(x, F.lit("")))
    out = None
    for phrase, op, confidence, kind, pattern in HINTS:
        value = F.struct(F.lit(phrase).alias("raw_phrase"), F.lit(op).alias("inferred_operator"), F.lit(confidence).alias("confidence"), F.lit(kind).alias("hint_kind"))
        out = F.when(low.rlike(pattern), value) if out is None else out.when(low.rlike(pattern), value)
    return out


def longest_phrase(x: Column, phrases: list[str]) -> Column:
    """FN-7: the longest of the phrases that x contains, the first of equally long ones."""
    out = None
    for p in sorted(phrases, key=len, reverse=True):
        out = F.when(x.contains(p), F.lit(p)) if out is None else out.when(x.contains(p), F.lit(p))
    return out


def code(digits: Column, prefix: str = "M") -> Column:
    """FN-15: without leading zeros, padded to three digits at least."""
    n = F.coalesce(F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit("")), F.lit("0"))
    return F.concat(F.lit(prefix), F.when(F.length(n) < 3, F.lpad(n, 3, "0")).otherwise(n))


def codes(x: Column, pattern: str = r"(?<![A-Za-z0-9])M-?(\d{1,5})(?![A-Za-z0-9])") -> Column:
    """FN-16: all codes of a text; those of zero are dropped."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(pattern), F.lit(1))
    return F.transform(F.filter(found, lambda d: ~d.rlike("^0+$")), lambda d: code(d))


def is_truthy(x: Column) -> Column:
    """FN-31."""
    return ~F.lower(F.trim(F.coalesce(x, F.lit("")))).isin("", "false", "0", "no", "n", "off")


def is_noise(x: Column, noise: list[str]) -> Column:
    """FN-6: empty, or begins with a noise string."""
    y = collapse(x)
    out = y == ""
    for n in noise:
        out = out | y.startswith(n)
    return out


def key_shape(x: Column, suffixes: tuple[str, ...], extra: tuple[str, ...] = ()) -> Column:
    """FN-9, FN-10: struct of ok and reason for a condition key."""
    bad = x.startswith("src_") | x.contains("source_")
    snake = x.rlike(r"^[a-z][a-z0-9]*(_[a-z0-9]+)*$")
    known = x.rlike(r"^leaf_[a-z0-9]+_[0-9a-f]{16}$") | x.rlike(r"_(increased|decreased)$") | x.isin(*extra, "")
    for s in suffixes:
        known = known | x.endswith("_" + s)
    reason = F.when(x.isNull() | (x == ""), "blank").when(bad, "source fragment").when(~snake, "not snake case").when(~known, "unknown suffix")
    return F.struct(reason.isNull().alias("ok"), reason.alias("reason"))


def count_of(x: Column, needle: str) -> Column:
    """AGG-19: places where needle stands, none overlapping."""
    return ((F.length(x) - F.length(F.replace(x, F.lit(needle)))) / len(needle)).cast("int")


def to_number(x: Column) -> Column:
    """S16: a number from text where Python's float() has one, else null; `1_0` is 10, `88d` is none."""
    y = F.trim(x)
    plain = F.when(y.rlike(r"^[+-]?(\d+(_\d+)*)?(\.(\d+(_\d+)*)?)?([eE][+-]?\d+)?$") & y.rlike(r"\d"), F.expr("1") * F.regexp_replace(y, "_", "").try_cast("double"))
    low = F.lower(F.regexp_replace(y, r"^\+", ""))
    return F.when(low.isin("inf", "infinity"), F.lit(float("inf"))).when(low.isin("-inf", "-infinity"), F.lit(float("-inf"))).when(low.isin("nan", "-nan"), F.lit(float("nan"))).otherwise(plain)


def preview(measurement: Column, op: Column, value: Column, unit: Column, review: Column) -> Column:
    """FN-11: `measurement op value [unit]`, and the review status unless it is ok."""
    number = F.when(value == F.floor(value), value.cast("long").cast("string")).otherwise(value.cast("string"))
    return F.concat(F.concat_ws(" ", measurement, op, number, F.when(unit != measurement, unit)), F.when(F.coalesce(review, F.lit("ok")) != "ok", F.concat(F.lit(" ["), review, F.lit("]"))).otherwise(""))
