"""What a capture brought: its class and reason, its popups in figures, and what its page alone shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .triggers import HINT, page_parts

#: The popup types that are counted by name, and what a page is searched for.
TYPES = ("definition", "citation", "footnote", "context", "other_popup")
NEEDLES = ("definition", "definitions", "tooltip", "popover", "glossary")
HIDDEN, DIALOGS = ("display:none", "visibility:hidden"), ('role="dialog"', "aria-modal")
#: Terms of popups and of pages: a name and patterns over lower-case text that must all be found.
POPUP_TERMS = {
    "hemodynamic_instability_found": [r"hemodynamic\s+instability"],
    "tachycardia_found": ["tachycardia"],
    "hypotension_found": ["hypotension"],
    "orthostatic_hypotension_found": ["orthostatic", "hypotension"],
    "altered_mental_status_found": [r"altered\s+mental\s+status"],
    "shock_index_found": [r"shock\s+index"],
    "mean_arterial_pressure_found": [r"mean\s+arterial\s+pressure"],
    "vasopressor_found": ["vasopressor|inotropic"],
    "lactate_found": ["lactate"],
}
PAGE_TERMS = {
    "definition_title": [r"definition\s*-\s*hemodynamic"],
    "tachycardia": ["tachycardia"],
    "shock_index": ["shock index"],
    "mean_arterial_pressure": ["mean arterial pressure"],
    "vasopressor": ["vasopressor"],
    "lactate": ["lactate"],
    "clinical_indications": ["clinical indications"],
}


def _object(text: str) -> Column:
    """The variant of a JSON text that is an object; null for other JSON, broken JSON and null."""
    v = F.try_parse_json(text)
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def _first(v: Column, path: str) -> Column:
    """The first element of a list as text, a null element being 'None'; null without a list or an element."""
    there = F.schema_of_variant(F.try_variant_get(v, path, "variant")).startswith("ARRAY") & (F.size(F.try_variant_get(v, path, "array<variant>")) > 0)
    return F.when(there, F.coalesce(F.try_variant_get(v, f"{path}[0]", "string"), F.lit("None")))


def _word(v: Column, path: str) -> Column:
    return F.coalesce(F.regexp_replace(F.try_variant_get(v, path, "string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def outcomes(captures: DataFrame) -> DataFrame:
    """VAL-32, FN-48: captures (manifest, manifest_error, preflight, preflight_error, and others), JSON texts and what went wrong
    reading them, with capture_class, reason, failed_ratio_pct, definition_count and popup_count.

    A manifest that says failed fails with its first reason; without a readable one the capture has failed too. Without a preflight
    it needs review. A manifest that needs review says why, else the preflight does; it passes where both pass. Texts that
    are no JSON objects aren't readable. The ratio is rounded half-even to one place, by its decimal digits."""
    m, p = F.col("_m"), F.col("_p")
    rows = captures.withColumn("_m", _object("manifest")).withColumn("_p", _object("preflight"))
    status, verdict = F.lower(_word(m, "$.capture_status")), F.upper(_word(p, "$.verdict"))
    own = _first(m, "$.capture_status_reasons")
    found = "$.checks.definition_capture_counts.definition_count"
    none = F.schema_of_variant(F.try_variant_get(p, found, "variant")).startswith("BIGINT") & (F.try_variant_get(p, found, "bigint") == 0)
    empty = F.schema_of_variant(p) == "OBJECT<>"
    why = F.when(empty, "preflight_missing_or_unreadable").otherwise(F.coalesce(_first(p, "$.reasons_review"), F.when(none, "definition_count=0"), F.lit("needs_review_unknown")))
    unset = lambda x: F.when(x == "", "unset").otherwise(x)
    passed = (status == "pass") & (verdict == "PASS")
    kind = F.when(m.isNull() | (status == "failed"), "failed").when(p.isNotNull() & passed, "pass").otherwise("needs_review")
    reason = (
        F.when(m.isNull(), F.coalesce(F.nullif("manifest_error", F.lit("")), F.lit("manifest_missing_after_capture")))
        .when(status == "failed", F.coalesce(own, F.lit("capture_failed")))
        .when(p.isNull(), F.coalesce(F.nullif("preflight_error", F.lit("")), F.lit("preflight_missing_after_audit")))
        .when(status == "needs_review", F.coalesce(own, why))
        .when(passed, "")
        .when(verdict == "NEEDS_REVIEW", why)
        .otherwise(F.concat(F.lit("manifest_status="), unset(status), F.lit(" verdict="), unset(verdict)))
    )
    ratio = F.try_variant_get(p, "$.checks.failure_pressure.ratio_vs_processed_attempts", "double")
    count = lambda name: F.coalesce(F.try_variant_get(m, f"$.definition_capture.{name}", "bigint"), F.lit(0))
    return rows.select(*captures.columns, kind.alias("capture_class"), reason.alias("reason"), F.bround(ratio * 100, 1).alias("failed_ratio_pct"), count("definition_count").alias("definition_count"), count("popup_count").alias("popup_count"))


def popup_audit(popups: DataFrame, by: list[str], terms: dict[str, list[str]] = POPUP_TERMS, definitions: int = 500, titles: int = 800) -> DataFrame:
    """AGG-16: one row for each capture (by) of popups (popup_id, popup_type, title, normalized_title, text, depth).

    Counts by type and in all, nested popups and the greatest depth, for each term whether all its patterns are found in
    title or text of a popup, the histogram of types, and the first titles of definitions and of all popups by type,
    normalised title and id, as many as asked for. A pattern isn't looked for across two popups. Null types count in all only."""
    said = F.lower(F.concat(F.coalesce("title", F.lit("")), F.lit(" \n "), F.coalesce("text", F.lit(""))))
    patterns = sorted({x for xs in terms.values() for x in xs})
    place = Window.partitionBy(*by).orderBy("popup_type", "normalized_title", "popup_id")
    kind = lambda x: F.count_if(F.col("popup_type") == x)
    names = [*(f"{x}_count" for x in TYPES), *(f"_t{i}" for i in range(len(patterns)))]
    # one row for each capture and type first, so that the histogram needs no rows of its own
    parts = popups.groupBy(*by, "popup_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("depth") > 0).alias("nested"), F.max("depth").alias("deepest"), *(F.bool_or(said.rlike(x)).alias(f"_t{i}") for i, x in enumerate(patterns))
    )
    figures = parts.groupBy(*by).agg(
        F.sum("n").alias("popup_count"),
        *(F.sum(F.when(F.col("popup_type") == x, F.col("n")).otherwise(0)).alias(f"{x}_count") for x in TYPES),
        F.sum("nested").alias("captured_nested_popup_count"),
        F.greatest(F.coalesce(F.max("deepest"), F.lit(0)), F.lit(0)).alias("max_depth_reached"),
        *(F.bool_or(f"_t{i}").alias(f"_t{i}") for i in range(len(patterns))),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("popup_type").isNotNull(), F.struct("popup_type", "n"))))).alias("popup_type_histogram"),
    )
    for name, wanted in terms.items():
        found = F.lit(True)
        for x in wanted:
            found = found & F.col(f"_t{patterns.index(x)}")
        figures = figures.withColumn(name, found)
    figures = figures.drop(*(x for x in names if x.startswith("_")))

    def first(rows: DataFrame, n: int, out: str) -> DataFrame:
        some = rows.withColumn("_k", F.row_number().over(place)).where(F.col("_k") <= n)
        return some.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("_k", "title"))), lambda x: x["title"]).alias(out))

    same = lambda x, y: [x[c].eqNullSafe(y[c]) for c in by]
    out = figures
    for rows, n, name in ((popups.where("popup_type = 'definition'"), definitions, "definition_titles"), (popups, titles, "popup_titles")):
        some = first(rows, n, name)
        out = out.join(some, same(out, some), "left").select(*(out[c] for c in out.columns), F.coalesce(some[name], F.array().cast("array<string>")).alias(name))
    return out


def _times(text: Column, needle: str) -> Column:
    """How often the needle stands in the text, without overlaps."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("long")


def page_audit(pages: DataFrame, key: str, terms: dict[str, list[str]] = PAGE_TERMS, wanted: str = "hemodynamic|instability", examples: int = 40, kinds: tuple[str, ...] | None = None) -> DataFrame:
    """VAL-34: what the html of each page (key, html, manifest_error) shows of popups that were not opened.

    Counts of needles, hidden styles, dialogs, frames and onclick; a flag for each term; the triggers' number and first texts;
    whether a trigger that hints at a popup (of those types only, if kinds are given) names what is wanted; and the likely mechanism: overlays (triggers, but no definition's title),
    not_inlined (no trigger), inspect (both), unknown (null html, which is warned of). Keys must be distinct."""
    low = F.lower(F.coalesce("html", F.lit("")))
    hint = F.lower(F.concat_ws(" ", "href", "onclick", "class", "title")).rlike(f"(?i){HINT.pattern}")
    if kinds is not None:
        hint = hint & F.col("popup_type").isin(*kinds)
    found = page_parts(pages.select(key, "html")).where("part = 'trigger'").select(key, "nth", "text", (F.lower("text").rlike(wanted) & hint).alias("named"))
    of_page = found.groupBy(F.col(key).alias("_key")).agg(
        F.count("*").alias("trigger_count"), F.bool_or("named").alias("wanted_trigger_found"), F.transform(F.array_sort(F.collect_list(F.when(F.col("nth") < examples, F.struct("nth", "text")))), lambda x: x["text"]).alias("trigger_examples")
    )
    flags = []
    for name, patterns in terms.items():
        every = F.lit(True)
        for x in patterns:
            every = every & low.rlike(x)
        flags.append(every.alias(name))
    total = lambda needles: sum((_times(low, x) for x in needles), F.lit(0).cast("long"))
    n, titled = F.coalesce("trigger_count", F.lit(0)), low.rlike(terms["definition_title"][0])
    mechanism = F.when(F.col("html").isNull(), "unknown").when(n == 0, "not_inlined").when(~titled, "overlays").otherwise("inspect")
    warnings = F.array_compact(F.array(F.when(F.col("html").isNull(), "expanded_html_missing"), F.nullif("manifest_error", F.lit(""))))
    return pages.join(of_page, F.col(key) == F.col("_key"), "left").select(
        key, *flags, low.rlike(wanted).alias("wanted_in_html"), F.coalesce("wanted_trigger_found", F.lit(False)).alias("wanted_trigger_found"), n.alias("trigger_count"), F.coalesce("trigger_examples", F.array().cast("array<string>")).alias("trigger_examples"),
        F.array(*(_times(low, x) for x in NEEDLES)).alias("needles"), total(HIDDEN).alias("hidden"), total(DIALOGS).alias("dialogs"), _times(low, "<iframe").alias("iframes"), (_times(low, "onclick") > 0).alias("onclick"), mechanism.alias("mechanism"), warnings.alias("warnings"),
    )


def best_link(links: Column, number: Column, variant: Column) -> Column:
    """RANK-11: the first of links (structs with text) whose first code has the number; null without one.

    Links of the excluded variant, whose text has RRG, count only where the variant is asked for."""

    def fits(link: Column) -> Column:
        text = F.coalesce(link["text"], F.lit(""))
        code = F.nullif(F.regexp_extract(text, r"(?iU)M[-\s]?([0-9]{2,5})", 1), F.lit(""))
        other = F.upper(text).contains("RRG") | F.replace(F.upper(text), F.lit(" "), F.lit("")).contains("-RRG")
        return F.coalesce((code.cast("long") == number) & (variant | ~other), F.lit(False))

    return F.get(F.filter(links, fits), F.lit(0))
