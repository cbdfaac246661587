"""Popup triggers, lists, item texts and matching against their DuckDB forms and against rows written by hand."""

import duckdb
import pytest
from pyspark.sql import functions as F

from arborix.functions import matching as m
from arborix.operators import triggers as t
from arborix.operators.html_nodes import parse
from arborix.plans import catalog, parts

DATA = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == parts.__name__]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    duck = duckdb.connect()
    for x in "documents pages lineitem".split():
        duck.execute(f"CREATE VIEW {x} AS SELECT * FROM '{DATA}/{x}.parquet'")
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    assert rows and rows == sorted(str(r) for r in want.fetchall())


def test_arguments():
    for source, want in {
        "pop('a, b', f(1,2), \"c\")": ["a, b", "f(1,2)", "c"],
        "POP('it\\'s', \"say \\\"x\\\"\", )": ["it's", 'say "x"'],
        "pop()": [],
        "pop( , ,)": [],
        "pop (1)": None,
        "none": None,
        "": None,
        "pop('open": None,
        "pop(1, 'a)'": None,
        "pop((1; pop(2)": ["2"],
        "xpop(f('(', ')'), [1, 2])": ["f('(', ')')", "[1", "2]"],
        "pop('a' + 'b', 'c'd)": ["'a' + 'b'"[1:-1], "'c'd"],
    }.items():
        assert t.arguments(source, "pop") == want, source
    assert t.arguments(None, "pop") is None


def test_classify():
    for source, want in {
        "popup_definition('d1', \"T\")": ("definition", "popup_definition", ["d1", "T"]),
        "popup_definition(1)": ("other_popup", "", None),
        "popup_definition('a','b','c'); popup_citation('4')": ("citation", "popup_citation", ["4"]),
        "popup_footnote (1)": ("footnote", "popup_footnote", None),
        "popup_footnote('A') popup_citation": ("footnote", "popup_footnote", ["A"]),
        "popup_mcm_context(7)": ("context", "popup_mcm_context", [7 and "7"]),
        "popup_my_context2('q')": ("context", "popup_my_context2", ["q"]),
        "popup_a(1); popup_b_context (2)": ("other_popup", "popup_a", ["1"]),
        "popup_a (": ("other_popup", "popup_a", None),
        "go()": ("other_popup", "", None),
    }.items():
        assert t.classify(source) == want, source
    assert t.classify(None) == ("other_popup", "", None)


PAGE = """<ul><li>One <div id="c-1">short</div><div id="e-1">long <b>text</b></div><a onclick="collapse('1')">less</a><img alt=x><a title="Annotation 3">[A]</a><ul><li>inner</li></ul> end</li>
<li><a onclick="popup_annotation('x')">x</a><a title="See Supporting evidence">y</a>only</li></ul>
<a href="/x">plain</a><a href="/glossary?x">G</a><a href="/glossary?x">G</a><a href="/glossary?y">G</a><a onclick="go()">Expand  All</a><div role="link" data-b="1" data-a>D<script>no</script></div><div onclick="popup_a(1)">not a tag</div>
<button onclick="x()">expand</button><button onclick="popup_q('1')">expand me</button><font onclick=" ">blank</font><a aria-label="tooltip &amp;lt;">L</a><a title="Print view" onclick="q()">p</a>
<h2>References</h2>text<p>x</p><ol><li>A <i>b</i>. DOI: 10.5/q.. [Context Link 1, B ,]<a>View abstract</a></li><li>c</li></ol><ol><li>z</li></ol>
<h2>Footnotes</h2><p class="a MsoFootnoteText">[ A ] see (3) and (12)</p><p class=MsoFootnoteText>[A] again</p><p class=MsoFootnoteText>no key</p><h3>on</h3><p class=MsoFootnoteText>[B2]</p><h2>x</h2><p class=MsoFootnoteText>[C] no</p>"""


def test_page_parts(spark):
    rows = t.page_parts(spark.createDataFrame([(1, PAGE, 5), (2, None, 6), (3, "", 7)], "page_id int, html string, name2 int")).orderBy("nth").collect()
    assert {r["page_id"] for r in rows} == {1} and [r["nth"] for r in rows] == list(range(len(rows)))
    of = lambda part: [r for r in rows if r["part"] == part]
    found = [(r["name"], r["text"], r["href"]) for r in of("trigger")]
    assert found == [("a", "less", ""), ("a", "x", ""), ("a", "g", "/glossary?x"), ("a", "g", "/glossary?y"), ("div", "d", ""), ("button", "expand me", ""), ("a", "l", "")]
    assert of("trigger")[4]["list"] == ["data-a", "data-b"] and of("trigger")[6]["title"] == "tooltip <"
    assert [(r["popup_type"], r["handler"], r["args"]) for r in of("trigger")][5] == ("other_popup", "popup_q", ["1"])
    assert [(r["name"], r["text"], r["href"], r["list"]) for r in of("reference")] == [("1", "A b . DOI: 10.5/q.. [Context Link 1, B ,]", "10.5/q", ["1", "B"]), ("2", "c", None, [])]
    assert [(r["name"], r["text"], r["list"]) for r in of("footnote")] == [("A", "see (3) and (12)", ["3", "12"]), ("B2", "", [])]
    assert [r["text"] for r in of("item")][:3] == ["One long text end", "inner", "only"]
    assert not list(t.references(parse("<h2>References</h2><h3>x</h3><ol><li>a</li></ol>"))) and not list(t.footnotes(parse("<p>")))


def test_expand_groups(spark):
    """The nearest one counts, up to 30 siblings before."""
    rows = [(1, k, f"expandall('g{k}')" if k in (0, 2) else "EXPANDALL('')" if k == 5 else "text" if k % 2 else None) for k in range(40)] + [(2, 0, "x")]
    got = {(r["p"], r["k"]): r["g"] for r in t.expand_groups(spark.createDataFrame(rows, "p int, k int, h string"), ["p"], "k", "h", "g").collect()}
    assert got[1, 0] is None and got[1, 1] == "g0" and got[1, 2] == "g0" and got[1, 3] == "g2" and got[1, 32] == "g2" and got[1, 33] is None and got[2, 0] is None
    far = [(1, 0, "expandall('a')")] + [(1, k, "") for k in range(1, 33)]
    got = {r["k"]: r["g"] for r in t.expand_groups(spark.createDataFrame(far, "p int, k int, h string"), ["p"], "k", "h", "g").collect()}
    assert got[1] == got[30] == "a" and got[31] is None


def values(spark, column, *rows):
    return [r[0] for r in spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "k int, a string, b string, c string").orderBy("k").select(column).collect()]


def test_lines_in_order(spark):
    rows = [(" x\n A1 \r\nB\nA2 C\n C ", "", ""), ("B\nA\nC", "", ""), (None, "", ""), ("A\nB*\nC.", "", "")]
    got = values(spark, m.lines_in_order(F.col("a"), F.array(F.lit("A"), F.lit("B"), F.lit("C"))), *rows)
    assert [(x["taken"], x["missing"]) for x in got] == [(["A1", "B", "C"], None), (["A"], "B"), ([], "A"), (["A", "B*", "C."], None)]


def test_word_near_code(spark):
    pad = "." * 43
    rows = [("ORG: M-83", "M083", ""), (f"ORG {pad} M83", "M083", ""), (f"ORG.{pad}... M83 ", "M083", ""), (f"M 083 {'.' * 12}org", "M083", ""), (f"M 083 {'.' * 19}org", "M083", ""), ("ORG M1083", "M083", ""), ("xM083 ORG", "M083", ""), (None, "M083", ""), ("ORG M083", None, ""), ("ORG a.b", "a.b", ""), ("no M083", "M083", ""), ("ORG M5", "M005", ""), ("M5", "M005", "")]
    assert values(spark, m.word_near_code(F.col("a"), F.col("b")), *rows) == [True, True, False, True, False, True, True, False, False, False, False, True, False]


def test_word_near_code_counts_characters(spark):
    """Letters whose upper case is longer take one place each, before a code and after it."""
    rows = [(f"ORG {'ß' * 40} M-083", "M083", ""), (f"ORG {'.' * 40} M-083", "M083", ""), (f"M-083 {'ﬃ' * 14} ORG", "M083", ""), (f"ORG {'ß' * 45} M-083", "M083", ""), (f"ﬀ{'ß' * 9}M 083 ORG", "M083", "")]
    assert values(spark, m.word_near_code(F.col("a"), F.col("b")), *rows) == [True, True, True, False, True]
    points = spark.range(1, 0x110000).where("id < 55296 OR id > 57343").selectExpr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32') AS c")
    assert points.where(F.length(m.upper_in_place(F.col("c"))) != F.length("c")).count() == 0
    assert points.where(F.col("c").rlike(m.LONGER) & (F.length(F.upper("c")) == 1)).count() == 0


def test_markers(spark):
    rows = [("ORG: M-083 and M 83", "m083", "T"), ("M0831", "M083", ""), ("a m0 83 b", "M083", None), (None, "M083", "x"), ("X-1 (y)", "x-1 (y)", ""), ("M5", "M005", "")]
    assert values(spark, m.code_markers(F.col("a"), F.col("b")), *rows) == [["ORG: M-083", "M token 083", "M token 83"], ["literal M083"], ["literal M083"], [], [], ["M token 5"]]
    assert values(spark, m.title_within(F.col("a"), F.col("b")), ("a  b\nc", "b c", ""), ("x – y", "x - y", ""), ("a.b", "a+b", ""), ("q", " ", ""), (None, "t", "")) == ["b c", "x - y", None, None, None]
    got = values(spark, m.page_markers(F.col("a"), F.col("b"), F.col("c"), ["Clinical Indications", "Admission"]), ("ORG: M-083 Care Admission", "M083", "Care"), ("ORG: M-083 Care", "M083", "Care"))
    assert [(x["markers"], x["complete"]) for x in got] == [(["ORG: M-083", "M token 083", "title:Care", "section:Admission"], True), (["ORG: M-083", "M token 083", "title:Care"], False)]
    assert values(spark, F.regexp_like(F.col("a"), m.quoted(F.col("b"))), ("a.b(c", "a.b(c", ""), ("aXb(c", "a.b(c", "")) == [True, False]


def test_popup_title(spark):
    title = t.popup_title(F.col("a"), F.col("b"))
    rows = [("x\n  Definition of   y\nz", "definition", ""), ("short: a\nlong enough: b", "definition", ""), ("a\nb", "definition", ""), ("--\n(3)", "citation", ""), ("--", "footnote", ""), ("a\nA Link here", "context", ""), ("\n z ", "other_popup", ""), ("", "definition", ""), (None, "x", ""), (" \n ", "other_popup", "")]
    assert values(spark, title, *rows) == ["Definition of y", "long enough: b", "a", "(3)", "--", "A Link here", "z", "", "", "Other Popup"]
