"""Response envelopes to typed rows (EVAL-14 to EVAL-19, FN-36 to FN-40), over JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(json: Column, path: str) -> Column:
    """A scalar as text, null for objects and arrays; an empty string is a value."""
    x = F.get_json_object(json, path)
    return F.when(~x.rlike(r"^\s*[\[{]"), x)


def first_then_text(json: Column, paths: list[str]) -> Column:
    """S17, safeStr(a ?? b): the first that is there, then as a scalar; an object there gives null."""
    x = F.coalesce(*[F.get_json_object(json, p) for p in paths])
    return F.when(~x.rlike(r"^\s*[\[{]"), x)


def text_then_first(json: Column, paths: list[str]) -> Column:
    """S17, safeStr(a) ?? safeStr(b): the first that is a scalar."""
    return F.coalesce(*[scalar(json, p) for p in paths])


#: What counts as a yes, a no and an unknown admission, and where an envelope may hold it, the first that says one of them (FN-37).
ADMISSION = {"YES": ("YES", "Y", "TRUE", "MET", "ADMIT"), "NO": ("NO", "N", "FALSE", "NOT_MET", "DENY"), "UNKNOWN": ("UNKNOWN", "UNCERTAIN", "INDETERMINATE")}
ENGINES = ("rule_engine", "deterministic_rule_engine", "rule_engine_result")
ENGINE_PLACES, TOP_PLACES = ("admission", "admission_recommendation", "admission_decision", "recommendation"), ("admission", "admission_decision")
INNER_PLACE, INNER_KEYS = "admission_recommendation", ("value", "status", "code", "result")


def admission_token(text: Column) -> Column:
    """FN-37: YES, NO or UNKNOWN; null for any other text, so that the next place is asked."""
    t = F.upper(text)
    out = F.when(t.isin(*ADMISSION["YES"]), "YES")
    return out.when(t.isin(*ADMISSION["NO"]), "NO").when(t.isin(*ADMISSION["UNKNOWN"]), "UNKNOWN")


def record(json: Column, *keys: str) -> Column:
    """The first of these that is an object, as text."""
    found = [F.get_json_object(json, f"$.{k}") for k in keys]
    return F.coalesce(*(F.when(x.rlike(r"^\s*\{"), x) for x in found))


def admission(json: Column) -> Column:
    """FN-37 over a whole envelope: four places of its rule engine, two of its own, then the inner recommendation; else UNKNOWN."""
    engine, inner = record(json, *ENGINES), record(json, INNER_PLACE)
    places = [admission_token(scalar(engine, f"$.{k}")) for k in ENGINE_PLACES] + [admission_token(scalar(json, f"$.{k}")) for k in TOP_PLACES]
    return F.coalesce(*places, admission_token(first_then_text(inner, [f"$.{k}" for k in INNER_KEYS])), F.lit("UNKNOWN"))


def criterion_result(result: Column, trilean: Column, matched: Column) -> Column:
    """FN-38: result, else trilean, else the matched flag; an empty text is there, and means UNKNOWN (S17)."""
    t = F.upper(F.coalesce(result, trilean, F.when(matched, "TRUE").when(~matched, "FALSE")))
    return F.when(F.coalesce(t, F.lit("")) == "", "UNKNOWN").when(t.isin("MATCHED", "MET"), "TRUE").otherwise(t)


def is_noise(status: Column, noise: tuple[str, ...]) -> Column:
    """FN-39."""
    return F.coalesce(F.upper(status).isin(*noise), F.lit(False))


def fact_mapped(key: Column, mapped: Column) -> Column:
    """EVAL-15."""
    return (F.coalesce(key, F.lit("")) != "") & F.coalesce(mapped, F.lit(True))


def signals(*arrays: Column) -> Column:
    """FN-40: the arrays' texts in a row."""
    return F.array_join(F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays]), " · ")


def criterion_stats(result: Column, noise: Column) -> dict[str, Column]:
    """AGG-18, S18: UNRESOLVED counts as unknown, noise doesn't count."""
    seen = ~noise
    return {"visible": F.count_if(seen), "matched": F.count_if(seen & (result == "TRUE")), "unknown": F.count_if(seen & result.isin("UNKNOWN", "UNRESOLVED"))}


#: Where an envelope may hold its criteria, the first list that isn't empty (EVAL-16).
CRITERIA, ENGINE_CRITERIA = ("evaluation_rows", "criteria_evaluations", "evaluations"), ("criteria", "top_criteria", "matched_criteria", "rows")


def _variant(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def variant_text(v: Column) -> Column:
    """S17, safeStr over a variant: texts, numbers and flags as text; null for what isn't there, null, lists and objects."""
    return F.when(~F.coalesce(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY|VOID)"), F.lit(True)), F.try_variant_get(v, "$", "string"))


def engine(v: Column) -> Column:
    """The rule engine's record: the first of three names that is an object."""
    return F.coalesce(*(F.when(_is_object(_variant(v, f"$.{k}")), _variant(v, f"$.{k}")) for k in ENGINES))


def criteria(envelopes: DataFrame, v: str) -> DataFrame:
    """EVAL-16: a row (pos, criterion) for each criterion of each envelope (a variant): of the first list that has any, three of the envelope's
    own, then four of its rule engine; an envelope without any has no row. The criteria stay variants."""
    lists = [_variant(F.col(v), f"$.{k}", "array<variant>") for k in CRITERIA] + [_variant(engine(F.col(v)), f"$.{k}", "array<variant>") for k in ENGINE_CRITERIA]
    first = F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists))
    return envelopes.select(*(c for c in envelopes.columns if c != v), F.posexplode(first).alias("pos", "criterion"))


def selected_module(v: Column, top_code: Column, top_title: Column, router_titles: Column) -> Column:
    """EVAL-17: struct of code and title, null without a code: the envelope's own, its selected module's, its module's, else the first router row's.

    router_titles maps the router rows' codes to titles, the first row of a code winning."""
    at = lambda path: _variant(v, path)
    code = F.coalesce(variant_text(at("$.selected_mcg_code")), variant_text(at("$.selected_module.code")), variant_text(at("$.module.code")), top_code)
    there = lambda x: F.when(~F.coalesce(F.is_variant_null(x), F.lit(True)), x)
    title = F.coalesce(variant_text(F.coalesce(there(at("$.selected_module.title")), there(at("$.selected_module.name")))), variant_text(at("$.module.title")), F.try_element_at(router_titles, code), top_title)
    return F.when(F.coalesce(code, F.lit("")) != "", F.struct(code.alias("code"), title.alias("title")))


#: The schema of a source tree and its top-level keys (VAL-1).
SOURCE_TREE, SOURCE_TREE_KEYS = "mcg_source_tree.v1", ("source_document", "sections", "source_nodes", "tables", "footnotes", "references", "codes", "collapse_expand_map", "audit")


def document_errors(v: Column, schema: str = SOURCE_TREE, keys: tuple[str, ...] = SOURCE_TREE_KEYS) -> Column:
    """VAL-1: what is wrong with a document (a variant): its schema version, and each key that is missing; a key that holds null is there."""
    version = variant_text(_variant(v, "$.schema_version"))
    wrong = F.when(~version.eqNullSafe(F.lit(schema)), F.concat(F.lit("schema_version mismatch: "), F.coalesce(version, F.lit("None"))))
    return F.array_compact(F.array(wrong, *(F.when(_variant(v, f"$.{k}").isNull(), F.lit(f"missing top-level key: {k}")) for k in keys)))
