"""Functions on guideline text, links, rows and rules, Column to Column (FN-*, PARSE-*, CLS-*, RANK-*, ID-3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import codes, collapse, for_hash


def _any(columns) -> Column:
    return reduce(lambda a, b: a | b, columns)


def node_type(text: Column, depth: Column, has_list: Column) -> Column:
    """FN-5: note, option, checklist_item, criterion_root or criterion_item."""
    low = F.lower(text)
    lists = (low.contains("includes") & low.endswith(":")) | low.contains("includes:")
    return F.when(low.startswith("note:"), "note").when(low.contains("may include"), "option").when(lists, "checklist_item").when((depth == 1) & has_list, "criterion_root").otherwise("criterion_item")


#: Domain, section keys and title of each rule of a section's domain, in order (PARSE-7).
DOMAINS = (
    ("admission", ("admission",), None), ("alternatives", ("alternatives",), "Alternatives to Admission"), ("optimal_recovery_course", ("optimal_recovery_course",), "Optimal Recovery Course"),
    ("extended_stay", ("extended_stay",), None), ("discharge", ("discharge", "discharge_planning", "discharge_destination"), None), ("references", ("references",), "References"),
    ("footnotes", ("footnotes",), "Footnotes"), ("codes", ("codes",), "Codes"), ("evidence_summary", ("evidence_summary", "related_cms"), "Evidence Summary"),
)
ADMISSION_ROLE = "Clinical Indications for Admission to Inpatient Care"


def section_domain(key: Column, title: Column, role: Column) -> Column:
    """PARSE-7: the domain of a section; a key without a rule is its own domain."""
    out = None
    for domain, keys, name in DOMAINS:
        hit = key.isin(*keys)
        if domain == "admission":
            hit = hit | (F.coalesce(role, F.lit("")) == ADMISSION_ROLE)
        elif domain == "evidence_summary":
            hit = hit | key.startswith("evidence_") | (title == name)
        elif name:
            hit = hit | (title.contains(name) if domain in ("alternatives", "optimal_recovery_course") else title == name)
        out = F.when(hit, domain) if out is None else out.when(hit, domain)
    return out.otherwise(key)


def is_prose(key: Column) -> Column:
    """PARSE-17."""
    return key.startswith("evidence_") | key.isin("related_cms", "evidence_summary")


def in_scope(node: Column, root: str) -> Column:
    """FN-44: the root or what is under it."""
    return (node == root) | node.startswith(root + ".")


def path_title(description: Column, original: Column) -> Column:
    """FN-14: what stands before `, as indicated` in the first text that isn't empty."""
    source = F.coalesce(F.nullif(description, F.lit("")), F.nullif(original, F.lit("")), F.lit(""))
    return F.trim(F.substring_index(source, ", as indicated", 1))


def match_headline(text: Column) -> Column:
    """FN-30: before the first colon, then before the first `( `."""
    return F.trim(F.substring_index(F.substring_index(F.trim(F.coalesce(text, F.lit(""))), ":", 1), "( ", 1))


def audit_headline(text: Column) -> Column:
    """FN-42: without one-letter brackets; a bracket and digit become a bracket alone."""
    y = F.regexp_replace(F.coalesce(text, F.lit("")), r"\[\s*[A-Za-z]\s*\]", "")
    return F.lower(collapse(F.regexp_replace(y, r"\(\s*\d", " (")))


def core_title(title: Column) -> Column:
    """FN-43: lower, without a leading `Definition -`."""
    t = F.trim(title)
    return F.lower(F.when(F.lower(t).startswith("definition -"), F.trim(F.substring(t, 13, 1_000_000))).otherwise(t))


def plain(text: Column) -> Column:
    """FN-28: lower ASCII letters and digits, all else one space."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), "ß", "ss"), "[^a-z0-9]+", " "))


def meaning_tokens(key: Column) -> Column:
    """FN-29: distinct parts of four letters or more, without one known suffix, sorted."""
    base = F.regexp_replace(key, "(_condition_present|_required)$", "")
    return F.array_sort(F.array_distinct(F.filter(F.split(base, "_"), lambda t: F.length(t) >= 4)))


def code_list(raw: Column) -> Column:
    """PARSE-28."""
    return F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ","), lambda p: F.trim(p)), lambda x: x != "")


def only_codes(raw: Column) -> Column:
    """FN-46: the distinct codes of a comma list, sorted; null without any text."""
    parts = F.transform(code_list(raw), lambda p: F.upper(p))
    found = F.flatten(F.transform(parts, lambda p: codes(p)))
    return F.when(F.trim(F.coalesce(raw, F.lit(""))) != "", F.array_sort(F.array_distinct(found)))


#: Parts of links that lead away from a page, in order (FN-49).
AWAY = ("login.mcg", "/login", "authorize", "callback", "index.html", "#top", "account", "/codes", "codes.htm", "/abstract", "abstract.htm", "/references", "references.htm")


def blocked(href: Column) -> Column:
    """FN-49: why a link isn't followed, else null."""
    low = F.lower(F.trim(F.coalesce(href, F.lit(""))))
    out = F.when(low == "", F.lit(None).cast("string")).when(low.startswith("http://") | low.startswith("https://"), "blocked absolute http(s) href")
    for part in AWAY:
        out = out.when(low.contains(part), f"blocked href contains '{part}'")
    return out


def fingerprint(text: Column, href: Column, onclick: Column, outer: Column) -> Column:
    """ID-3: a hash of four normalised fields, three of them cut."""
    cut = lambda x, n: for_hash(F.substring(F.coalesce(x, F.lit("")), 1, n))
    return F.sha1(F.concat_ws("|", for_hash(text), cut(href, 400), cut(onclick, 400), cut(outer, 800)))


def pipe_fields(row: Column) -> Column:
    """PARSE-34: struct of code, product, type and title of `a | b | c | rest`; empty parts don't count."""
    parts = F.filter(F.transform(F.split(F.coalesce(row, F.lit("")), r"\|"), lambda p: F.trim(p)), lambda x: x != "")
    at = lambda i: F.coalesce(F.get(parts, F.lit(i)), F.lit(""))
    rest = F.array_join(F.when(F.size(parts) > 3, F.slice(parts, 4, 100_000)).otherwise(F.array().cast("array<string>")), " | ")
    return F.struct(at(0).alias("code"), at(1).alias("product"), at(2).alias("type"), rest.alias("title"))


def row_score(row: Column, digits: str, variant: bool, title: str) -> Column:
    """RANK-4: hard rejects first, then points for product, type and title."""
    low, own = F.lower(F.coalesce(row, F.lit(""))), pipe_fields(row)
    named = F.coalesce(row, F.lit("")).rlike(rf"(?i)M[-\s]?{digits}(?:\b|[\-_])")
    code, product, kind = F.lower(own["code"]), F.upper(own["product"]), F.upper(own["type"])
    points = F.when(product.contains("ISC") | row.rlike(r"(?i)\|\s*ISC\s*\|"), 400).otherwise(0)
    if variant:
        points = points + F.when(kind.contains("RRG"), 550).otherwise(0)
    else:
        points = points + F.when(kind.contains("ORG") | row.rlike(r"(?i)\|\s*ORG\s*\|"), 650).otherwise(0)
    if title.strip():
        points = points + F.when(low.contains(title.strip().lower()[:52]), 220).otherwise(0)
    out = F.when(~named, -99999)
    if variant:
        out = out.when(~low.contains("rrg"), -8500)
    else:
        out = out.when(kind.contains("RRG") | row.rlike(rf"(?i)M[-\s]?{digits}[-\s]*RRG") | F.replace(low, F.lit(" "), F.lit("")).contains("-rrg") | code.contains("rrg"), -100000)
    return out.otherwise(points)


def exit_code(status: Column, lenient: Column) -> Column:
    """FN-56."""
    return F.when(status == "failed", 1).when((status == "needs_review") & ~lenient, 1).otherwise(0)


def login_markers(code: Column, title: Column) -> Column:
    """FN-57: title, code, and the code's number without leading zeros."""
    c, t = F.trim(code), F.trim(title)
    digits = F.nullif(F.regexp_extract(c, r"(?i)^M(\d+)$", 1), F.lit(""))
    number = F.coalesce(F.nullif(F.regexp_replace(digits, "^0+", ""), F.lit("")), F.when(digits.isNotNull(), "0"))
    return F.array_compact(F.array(F.nullif(t, F.lit("")), F.nullif(c, F.lit("")), F.concat(F.lit("M-"), number)))


def grew(text_before: Column, html_before: Column, text_after: Column, html_after: Column, text_least: int, html_least: int) -> Column:
    """FN-50."""
    return (text_after - text_before >= text_least) | (html_after - html_before >= html_least)


def merged_ids(first: Column, second: Column) -> Column:
    """JOIN-19: ids of both lists, trimmed, each once, in order."""
    both = F.transform(F.concat(first, second), lambda x: F.trim(F.coalesce(x, F.lit(""))))
    return F.array_distinct(F.filter(both, lambda x: x != ""))


def collapse_map(html: Column) -> Column:
    """PARSE-18: map of groups to their ids from `var collapseExpandMap = {A:["x","y"]};` in the first 500,000 characters; of a repeated group the last."""
    inner = F.regexp_extract(F.substring(F.coalesce(html, F.lit("")), 1, 500_000), r"(?s)var\s+collapseExpandMap\s*=\s*\{([^}]*)\}\s*;", 1)
    pairs = F.regexp_extract_all(inner, F.lit(r"([A-Z0-9]+\s*:\s*\[[^\]]*\])"), F.lit(1))
    key = lambda p: F.regexp_extract(p, r"^([A-Z0-9]+)", 1)
    ids = lambda p: F.filter(F.transform(F.split(F.regexp_extract(p, r"\[([^\]]*)\]", 1), ","), lambda x: F.btrim(F.btrim(F.trim(x), F.lit('"')), F.lit("'"))), lambda x: x != "")
    empty = F.create_map().cast("map<string,array<string>>")
    return F.aggregate(pairs, empty, lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != key(p)), F.create_map(key(p), ids(p))))


def collapse_pair(groups: Column, group: Column) -> Column:
    """PARSE-20: struct of the expanded and the collapsed id of a group."""
    ids = groups[group]
    return F.struct(F.nullif(F.get(ids, F.lit(0)), F.lit("")).alias("expanded"), F.nullif(F.get(ids, F.lit(1)), F.lit("")).alias("collapsed"))


def popup_body(raw: Column) -> Column:
    """PARSE-30: lines after the first, without empty ones and `Close`."""
    lines = F.split(F.trim(F.coalesce(raw, F.lit(""))), "\r?\n")
    rest = F.filter(F.transform(F.slice(lines, 2, 1_000_000), lambda p: F.trim(p)), lambda x: (x != "") & (x != "Close"))
    return F.array_join(rest, "\n")


def has_terms(text: Column, terms: list[str]) -> Column:
    """FN-35: any of the terms, in any case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return _any([low.contains(t) for t in terms])


def probe_flags(text: Column, terms: list[str]) -> Column:
    """FN-27: a map of each term and whether the text has it."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.map_from_arrays(F.array(*[F.lit(t) for t in terms]), F.array(*[low.contains(t) for t in terms]))


def is_guideline(body: Column, page_title: Column, h1: Column, marks: tuple[str, ...] = ("ORG", "CLINICAL INDICATIONS")) -> Column:
    """FN-20: a marker and a code in titles or the first 12,000 characters."""
    blob = F.concat_ws("\n", F.coalesce(page_title, F.lit("")), F.coalesce(h1, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, 12_000))
    upper = F.upper(blob)
    return _any([upper.contains(m) for m in marks]) & (F.size(codes(blob)) > 0)


def primary_code(body: Column, mark: str = "ORG") -> Column:
    """FN-17: the first code whose surroundings (24 characters before, 8 after) hold the mark, else the first."""
    raw = F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(r"(?<![A-Za-z0-9])(M-?\d{1,5})(?![A-Za-z0-9])"), F.lit(1))
    upper = F.upper(body)

    def near(c: Column) -> Column:
        at = F.call_function("instr", upper, F.upper(c)) - 1
        start = F.greatest(F.lit(0), at - 24)
        return F.substring(upper, start + 1, at + F.length(c) + 8 - start).contains(mark)

    best = F.coalesce(F.get(F.filter(raw, near), F.lit(0)), F.get(raw, F.lit(0)))
    return F.get(codes(best), F.lit(0))


def atom_label(measurement: Column, op: Column, value: Column, unit: Column, key: Column, original: Column, own: Column) -> Column:
    """FN-12: `measurement op value [unit]`, else the key, else the text, else the id; values are text."""
    full = (F.coalesce(measurement, F.lit("")) != "") & (F.coalesce(op, F.lit("")) != "") & (F.coalesce(value, F.lit("")) != "")
    return F.when(full, F.concat_ws(" ", measurement, op, value, F.nullif(unit, F.lit("")))).otherwise(F.coalesce(F.nullif(key, F.lit("")), F.nullif(collapse(original), F.lit("")), own))


def node_label(kind: Column, op: Column, key: Column, text: Column) -> Column:
    """FN-55: `[kind / operator / key] text`."""
    prefix = F.concat_ws(" / ", *[F.nullif(x, F.lit("")) for x in (kind, op, key)])
    return F.when(prefix != "", F.concat(F.lit("["), prefix, F.lit("] "), collapse(text))).otherwise(collapse(text))


def trace_value(flag: Column, number: Column) -> Column:
    """FN-13 of a fact that is a flag, a number as text, or nothing."""
    return F.when(flag.isNotNull(), F.when(flag, "true").otherwise("false")).otherwise(number)


def equal_number(got: Column, expected: Column) -> Column:
    """FN-52: equal as numbers; text that is no number isn't."""
    return F.coalesce(F.trim(got).try_cast("double") == expected, F.lit(False))


def is_numeric_minimal(kind: Column, op: Column, number: Column) -> Column:
    """CLS-3: an atomic comparison with a number."""
    return F.coalesce((kind == "atomic") & op.isin(">", ">=", "<", "<=", "==") & number.isNotNull(), F.lit(False))


def is_pediatric(key: Column, *texts: Column) -> Column:
    """CLS-4."""
    return F.lower(F.concat_ws(" ", key, *texts)).contains("pediatric") | key.startswith("pediatric_")
