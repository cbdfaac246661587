"""Audits of captures against their DuckDB forms and against rows written by hand."""

import duckdb
import pytest
from pyspark.sql import functions as F

from arborix.operators import capture as o
from arborix.plans import capture, catalog

DATA = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == capture.__name__]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    duck = duckdb.connect()
    for x in "orders lineitem documents pages".split():
        duck.execute(f"CREATE VIEW {x} AS SELECT * FROM '{DATA}/{x}.parquet'")
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    assert rows and rows == sorted(str(r) for r in want.fetchall())


def test_outcomes(spark):
    cases = [
        (None, None, '{"verdict":"PASS"}', None, "failed", "manifest_missing_after_capture", None, 0, 0),
        ("nonsense", "bad json", None, None, "failed", "bad json", None, 0, 0),
        ('{"capture_status":" FAILED","capture_status_reasons":[null]}', None, None, None, "failed", "None", None, 0, 0),
        ('{"capture_status":"failed","capture_status_reasons":[]}', None, None, None, "failed", "capture_failed", None, 0, 0),
        ('{"capture_status":"pass","definition_capture":{"definition_count":3,"popup_count":9}}', None, None, "gone", "needs_review", "gone", None, 3, 9),
        ('{"capture_status":"pass"}', None, '{"verdict":" pass ","checks":{"failure_pressure":{"ratio_vs_processed_attempts":0.0625}}}', None, "pass", "", 6.2, 0, 0),
        ('{"capture_status":"pass"}', None, '{"verdict":"needs_review","checks":{"definition_capture_counts":{"definition_count":0}}}', None, "needs_review", "definition_count=0", None, 0, 0),
        ('{"capture_status":"needs_review"}', None, "{}", None, "needs_review", "preflight_missing_or_unreadable", None, 0, 0),
        ('{"capture_status":"needs_review"}', None, '{"verdict":"PASS"}', None, "needs_review", "needs_review_unknown", None, 0, 0),
        ('{"capture_status":"needs_review","capture_status_reasons":["a","b"]}', None, '{"verdict":"PASS","reasons_review":["c"]}', None, "needs_review", "a", None, 0, 0),
        ("{}", None, '{"verdict":"PASS"}', None, "needs_review", "manifest_status=unset verdict=PASS", None, 0, 0),
        ('{"capture_status":"pass"}', None, '{"verdict":null}', None, "needs_review", "manifest_status=pass verdict=unset", None, 0, 0),
    ]
    df = spark.createDataFrame([(k, *c[:4]) for k, c in enumerate(cases)], "k int, manifest string, manifest_error string, preflight string, preflight_error string")
    got = sorted(o.outcomes(df).select("k", "capture_class", "reason", "failed_ratio_pct", "definition_count", "popup_count").collect())
    assert [tuple(r)[1:] for r in got] == [c[4:] for c in cases]


def test_popup_audit(spark):
    rows = [
        ("A", 2, "definition", "Beta", "beta", "Orthostatic drop", 0),
        ("A", 1, "definition", "Alpha hemodynamic", "alpha", "Instability", 2),
        ("A", 3, None, None, None, None, None),
        ("A", 4, "citation", "Hypotension", "hypotension", None, 1),
        (None, 5, "odd", "x", "x", "orthostatic", -1),
    ]
    df = spark.createDataFrame(rows, "code string, popup_id int, popup_type string, title string, normalized_title string, text string, depth int")
    got = {r["code"]: r for r in o.popup_audit(df, ["code"], definitions=1, titles=3).collect()}
    a, b = got["A"], got[None]
    assert (a["popup_count"], a["definition_count"], a["citation_count"], a["footnote_count"], a["captured_nested_popup_count"], a["max_depth_reached"]) == (4, 2, 1, 0, 2, 2)
    assert a["hemodynamic_instability_found"] and a["orthostatic_hypotension_found"] and not a["lactate_found"] and not b["orthostatic_hypotension_found"]
    assert a["definition_titles"] == ["Alpha hemodynamic"] and a["popup_titles"] == [None, "Hypotension", "Alpha hemodynamic"]
    assert a["popup_type_histogram"] == {"definition": 2, "citation": 1} and b["popup_type_histogram"] == {"odd": 1} and b["definition_titles"] == [] and b["max_depth_reached"] == 0
    assert o.popup_audit(df.limit(0), ["code"]).count() == 0


def test_page_audit(spark):
    rows = [
        (1, "<p>Definition - Hemodynamic</p><a href='#' onclick=\"popup_definition('1','t')\">Instability</a><iframe></iframe>", None),
        (2, "<div style='display:none'>glossary Definitions</div>", "no manifest"),
        (3, None, ""),
        (4, "<a href='#' onclick=\"popup_definition('1','t')\">Other</a>", None),
        (5, "", None),
    ]
    got = {r["k"]: r for r in o.page_audit(spark.createDataFrame(rows, "k int, html string, manifest_error string"), "k").collect()}
    assert [got[k]["mechanism"] for k in (1, 2, 3, 4, 5)] == ["inspect", "not_inlined", "unknown", "overlays", "not_inlined"]
    assert got[1]["wanted_trigger_found"] and not got[4]["wanted_trigger_found"] and got[1]["trigger_examples"] == ["instability"]
    assert (got[1]["iframes"], got[1]["onclick"], got[2]["hidden"], got[2]["needles"]) == (1, True, 1, [1, 1, 0, 0, 1])
    assert [got[k]["warnings"] for k in (2, 3, 5)] == [["no manifest"], ["expanded_html_missing"], []]


def test_page_query_kinds_and_references(spark, tmp_path):
    """A page whose only link with a wanted name is one to a context, and links with references: as the SQL has them. The operator counts every type unless told."""
    links = [["reshon"], ["reshon", "of", "anon"], ["the"], ["ofon&amp;&amp;", "of&lt;"], ["&amp"], []]
    page = lambda xs: "<nav><ul>" + "".join(f'<li><a href="/{x}">{x}</a></li>' for x in xs) + "</ul></nav>"
    spark.createDataFrame([(k, page(xs)) for k, xs in enumerate(links)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = duck.execute(catalog.SQL["page_capture_audit"])
    columns = [d[0] for d in want.description]
    got = catalog.QUERIES["page_capture_audit"](spark, str(tmp_path)).select(*columns).collect()
    assert len(got) == 6 and sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    named = lambda **more: o.page_audit(capture._with_triggers(spark, str(tmp_path)).withColumn("manifest_error", F.lit("")), "page_id", wanted="on|th", **more).where("wanted_trigger_found").count()
    assert (named(), named(kinds=("footnote",))) == (3, 1)


def test_best_link(spark):
    rows = [(["M-0083 RRG", None, "xM 83"], 83, False, "xM 83"), (["M83 r r-R RG", "m 083"], 83, True, "M83 r r-R RG"), (["M-8", "M-830"], 83, True, None), ([], 83, True, None), (None, 83, True, None)]
    df = spark.createDataFrame([(k, t, n, v) for k, (t, n, v, _) in enumerate(rows)], "k int, texts array<string>, n int, v boolean").selectExpr("*", "transform(texts, x -> named_struct('text', x)) AS links")
    from pyspark.sql import functions as F

    got = sorted(df.select("k", o.best_link(F.col("links"), F.col("n"), F.col("v"))["text"].alias("t")).collect())
    assert [r["t"] for r in got] == [r[3] for r in rows]
