"""The operators on small fixtures, and the catalogue against DuckDB."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from arborix.functions import kleene, text
from arborix.operators import definitions, evaluate, html_nodes, tables, validate
from arborix.operators.evaluate import Atom, Composite, Node, Rules
from arborix.plans import catalog
from arborix.sources import io

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


def norm(v):
    return tuple(map(norm, v)) if isinstance(v, list) else round(v, 6) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


@pytest.mark.skipif(not Path(DATA).exists(), reason="no driver tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_catalogue(spark, duck, name):
    df = catalog.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(norm(r[c]) for c in columns)) for r in df.collect())
    r = duck.execute(catalog.SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(norm(x[names.index(c)]) for c in columns)) for x in r.fetchall())


def truth(rules, i, facts):
    """The verdicts again, in plain Python."""
    if i in rules.atom:
        a = rules.atom[i]
        f = facts.get(a.key)
        if a.review == "needs_review" or a.ready is False:
            return 1
        if a.kind == "atomic_flag":
            return 2 if f is True else 0
        if f is None:
            return 0
        return 2 if {">": f > a.value, ">=": f >= a.value, "<": f < a.value, "<=": f <= a.value, "==": f == a.value}[a.operator] else 0
    if i in rules.node and not rules.node[i].children:
        below = rules.children(i)
        return truth(rules, below[0], facts) if below else 1
    own = rules.node.get(i) or rules.composite.get(i)
    if own is None or getattr(own, "review", "ok") == "needs_review":
        return 1
    below = [truth(rules, c, facts) for c in own.children]
    return max(below, default=0) if own.operator == "OR" else min(below, default=2) if own.operator == "AND" else 1


def some_rules(seed):
    r = random.Random(seed)
    atoms = [Atom(f"a{k}", f"k{k}", *(("atomic_flag", "IS_TRUE", None) if k % 2 else ("atomic_numeric", r.choice([">", ">=", "<", "<=", "=="]), float(r.randint(0, 3)))), review=r.choice(["ok", "ok", "ok", "needs_review"]), ready=r.choice([True, None, None, False])) for k in range(6)]
    composites = []
    for k in range(5):
        pool = [a.id for a in atoms] + [c.id for c in composites] + ["nowhere"]
        composites.append(Composite(f"c{k}", r.choice(["AND", "OR", "OR", "OPTIONS"]), tuple(r.sample(pool, r.randint(1, 4))), r.choice(["ok", "ok", "needs_review"])))
    leaves = [Node(f"l{k}", key=f"q{k}") for k in range(4)]
    tops = [Node(f"t{k}", r.choice(["AND", "OR"]), tuple(x.id for x in r.sample(leaves, 2))) for k in range(3)]
    return Rules(atoms, composites, leaves + tops, [(t.id, t.id) for t in tops], {f"q{k}": r.choice([c.id for c in composites] + ["a1", "gone"]) for k in range(4)})


@pytest.mark.parametrize("seed", range(4))
def test_evaluators_agree(spark, seed):
    rules, r = some_rules(seed), random.Random(seed + 99)
    cases = {c: {f"k{k}": r.choice([True, False, None]) if k % 2 else r.choice([0.0, 1.0, 2.0, 3.0, None, float("nan")]) for k in range(6)} for c in range(12)}
    wide = spark.createDataFrame([(c, *[f[f"k{k}"] for k in range(6)]) for c, f in cases.items()], "case_id long, " + ", ".join(f"{'b' if k % 2 else 'n'}_k{k} {'boolean' if k % 2 else 'double'}" for k in range(6)))
    long = spark.createDataFrame([(c, k, "bool" if isinstance(v, bool) else "num", v if isinstance(v, bool) else None, v if isinstance(v, float) else None) for c, f in cases.items() for k, v in f.items() if v is not None], "case_id long, condition_key string, fact_kind string, b boolean, n double")
    a = {row["case_id"]: row.asDict() for row in evaluate.compiled(rules, wide).collect()}
    b = {(row["case_id"], row["id"]): row["trit"] for row in evaluate.relational(rules, long, wide).collect()}
    for c, f in cases.items():
        for i in [*rules.atom, *rules.composite, *rules.node]:
            assert a[c][f"t_{i}"] == b[c, i] == truth(rules, i, f), (c, i)


def test_kleene_and_numbers(spark):
    assert spark.range(1).select(kleene.any_of([F.lit(0), F.lit(1)]), kleene.all_of([]), kleene.any_of([])).first()[:] == (1, 2, 0)
    rows = spark.createDataFrame([(" 88 ",), ("88d",), ("1_0",), ("inf",), ("x",), ("1e3",)], "x string").select(text.to_number(F.col("x")).alias("n")).collect()
    assert [r["n"] for r in rows] == [88.0, None, 10.0, float("inf"), None, 1000.0]
    with pytest.raises(ValueError):
        kleene.compare(F.lit(1.0), "!=", F.lit(2.0))
    with pytest.raises(ValueError):
        Rules([], [Composite("a", "OR", ("b",)), Composite("b", "OR", ("a",))], [], [])
    with pytest.raises(KeyError):
        Rules([], [], [Node("n", "OR", ("gone",))], [])


def test_text(spark):
    one = lambda c, x: spark.createDataFrame([(x,)], "x string").select(c(F.col("x"))).first()[0]
    assert one(text.collapse, " a  b\n") == "a b"
    assert one(text.strip_marks, "Fever [A] (3 days) :") == "Fever )"
    assert one(text.slug, "Definition - Some  Thing!") == "some_thing"
    assert one(text.slug, None) == "untitled"
    assert one(text.codes, "M-85 M0 XM7 M190a m1 M007") == ["M085", "M007"]
    assert one(lambda c: text.logic_hint(c)["inferred_operator"], "All of the following, may include") == "AND"
    assert one(lambda c: text.logic_hint(c), "eg, x") is None
    assert one(text.is_truthy, "No") is False
    assert one(lambda c: text.key_shape(c, ("rate",))["reason"], "source_rate") == "source fragment"
    assert one(lambda c: text.key_shape(c, ("rate",))["ok"], "heart_rate") is True


def test_definitions(spark):
    rules = spark.createDataFrame([("b", "x", 0, False, "real"), ("b", "x", 1, True, "later"), ("c", "y", 0, False, "shut"), ("c", "z", 0, True, "placeholder")], "bundle string, id string, position int, placeholder boolean, body string")
    bundles = spark.createDataFrame([("b", 1), ("c", 0)], "bundle string, bundle_order long")
    gates = spark.createDataFrame([("b", True)], "bundle string, open boolean")
    assert sorted((r["id"], r["body"]) for r in definitions.load_bundles(bundles, rules, gates).collect()) == [("x", "real"), ("z", "placeholder")]
    meta, stub = spark.createDataFrame([("k", "a"), ("m", "b")], "k string, v string"), spark.createDataFrame([("k", None)], "k string, v string")
    assert sorted((r["k"], r["v"]) for r in definitions.overlay(meta, stub, "k", ["v"]).collect()) == [("k", None), ("m", "b")]
    assert spark.range(1).select(definitions.excerpt_gate(F.lit("Some Body"), ["body", "gone"])).first()[0] == ["gone"]


def test_validators_catch(spark):
    nodes = spark.createDataFrame([("a", None, 1, "OR", ["b"]), ("b", "a", 3, "", []), ("x", "y", 2, "criteria_intro", []), ("y", "x", 2, "AND", ["x", "b"])], "id string, parent string, depth int, operator string, children array<string>")
    assert {r["entity_id"] for r in validate.depth(nodes).collect()} == {"b", "x", "y"}
    assert {r["entity_id"] for r in validate.reachable(nodes, tables.walk_down(nodes.select("id", "parent"))).collect()} == {"x", "y"}
    assert {r["entity_id"] for r in validate.arity(nodes).collect()} == {"a", "x"}
    assert {r["entity_id"] for r in validate.listed(nodes).collect()} == {"y"}
    stated = spark.createDataFrame([("n", 1), ("m", 2)], "metric string, value int")
    assert [r["entity_id"] for r in validate.agrees(stated, spark.createDataFrame([("n", 1)], "metric string, value int")).collect()] == ["m"]


def test_html(spark):
    page = "<h2>A</h2><ul><li>one<ul><li>sub</li></ul><li></li><li>three</ul><p>x<p>y<table><tr><td>1<td>2</table><meta name=k content=1><meta name=k content=2>"
    rows = [(k, i, p, t) for k, _, i, p, _, _, t, _ in html_nodes.records(page)]
    assert ("item", "s001.001", "s001", "one") in rows and ("item", "s001.001.001", "s001.001", "sub") in rows and ("item", "s001.003", "s001", "three") in rows
    assert [t for k, _, _, t in rows if k == "paragraph"][:2] == ["x", "y"] or [t for k, _, _, t in rows if k == "paragraph"][0].startswith("x")
    assert [(i, t) for k, i, _, t in rows if k == "cell"] == [("0.0", "1"), ("0.1", "2")]
    assert [t for k, _, _, t in rows if k == "meta"] == ["2"]
    assert html_nodes.call_arguments("go(); pop('a, b', f(1,2), \"c\")", "pop") == ["a, b", "f(1,2)", "c"]
    apart = html_nodes.records("<h1>a<b>b</b></h1><p>one.<br>two<i> three</i></p><p> <b></b> </p><ul><li>x<b>y</b><ul><li>z</li></ul></li></ul>")
    assert [(r[0], r[6]) for r in apart] == [("section", "ab"), ("paragraph", "one. two three"), ("item", "x y"), ("item", "z")]
    assert html_nodes.call_arguments("none") is None
    assert html_nodes.extract(spark.createDataFrame([(1, None), (2, page)], "page_id long, html string")).count() == len(rows)


def test_cut_references(spark, duck, tmp_path):
    """A title that was cut within a reference: as its SQL has it; the records of a page read it as browsers do."""
    page = "<html lang=\"en\"><head><title>a&amp;&amp</title></head><body><nav><ul><li><a href=\"/x?b&copy=1\">b &lt;&am</a></li></ul></nav><article><h1>a&amp;&amp</h1><p>x &amp;lt; &nosuch; & &lt</p></article></body></html>"
    assert [r[6] for r in html_nodes.records(page)][0] == "a&&" and html_nodes.whole_references("&#39;&#x27;&amp;&amp&#3") == "&#39;&#x27;&amp;&amp;amp&amp;#3"
    spark.createDataFrame([(1, page), (2, page.replace("&amp</", "</"))], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    sql = catalog.SQL["html_nodes_all"].replace("FROM pages", f"FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = duck.execute(sql)
    columns = [d[0] for d in want.description]
    got = catalog.QUERIES["html_nodes_all"](spark, str(tmp_path)).select(*columns).collect()
    assert len(got) == 10 and sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    assert {r["text"] for r in got if r["kind"] == "title"} == {"a&&amp", "a&"}


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("[1]")
    (tmp_path / "c.json").write_text("{")
    wanted = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.json", "b.json", "c.json", "d.json")], "path string")
    found = {r["path"][-6:]: r["error"] for r in io.optional_json(spark, wanted, str(tmp_path / "*.json")).collect()}
    assert found == {"a.json": None, "b.json": "expected_object_got", "c.json": "invalid_json", "d.json": "missing"}
    (tmp_path / "m.json").write_text('[{"code": "M1", "url": "u", "url_status": "odd"}, {"code": "", "url": "u"}, {"code": "M2", "url": "u", "url_status": "search_page"}]')
    good, bad = io.manifest(spark, str(tmp_path / "m.json"))
    assert [r["url_status"] for r in good.collect()] == ["canonical"] and bad.count() == 2
    io.write_jsonl(good, str(tmp_path / "out"))
    assert io.jsonl(spark, str(tmp_path / "out"), "code string, url string").count() == 1


def test_stream(spark, tmp_path):
    from arborix.streaming import logs

    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"ts": "2024-01-01T00:00:00Z", "code": "M1", "status": "pass", "text": "a"}\n' * 2 + '{"ts": "2024-01-01T05:00:00Z", "code": "M1", "status": "pass", "text": "b"}\n')
    logs.status_rollup(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r["n"] for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [2]
    logs.append_log(spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "cp2"), "ts timestamp, code string, text string", ["code", "text"]).awaitTermination()
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def fall(fact, less, op, limit, review):
    """The verdict of an atom over two facts: values are numbers, None (missing) or a text that is no number."""
    if review == "needs_review":
        return 1
    if fact is None or less is None:
        return 0
    if isinstance(fact, str) or isinstance(less, str):
        return 1
    d = fact - less
    return 2 if {">": d > limit, ">=": d >= limit, "<": d < limit, "==": d == limit}[op] else 0


@pytest.mark.parametrize("seed", range(3))
def test_paired_facts(spark, seed):
    """Both evaluators on atoms over differences: missing, unreadable, infinite and NaN operands."""
    r = random.Random(seed)
    pool = [0.0, 1.0, 2.5, -1.0, None, float("nan"), float("inf"), float("-inf")]
    atoms = [Atom(f"p{k}", f"k{r.randrange(3)}", "atomic_numeric", r.choice([">", ">=", "<", "=="]), r.choice([0.0, 1.0, 1.5]), review=r.choice(["ok", "ok", "ok", "needs_review"]), minus=f"k{r.randrange(3)}") for k in range(6)] + [Atom("flag", "k3")]
    rules = Rules(atoms, [Composite("any", "OR", ("p0", "p1", "flag")), Composite("all", "AND", ("any", "p2", "p3")), Composite("lost", "OR", ("p4", "nowhere"))], [Node("n", key="q")], [("n", "n")], {"q": "all"})
    assert rules.keys() == {"k0": "atomic_numeric", "k1": "atomic_numeric", "k2": "atomic_numeric", "k3": "atomic_flag"} or set(rules.keys()) <= {"k0", "k1", "k2", "k3"}
    cases = {c: [r.choice(pool) for _ in range(3)] + [r.choice([True, None])] for c in range(30)}
    wide = spark.createDataFrame([(c, *f) for c, f in cases.items()], "case_id long, n_k0 double, n_k1 double, n_k2 double, b_k3 boolean")
    rows = [(c, f"k{k}", "bool" if k == 3 else "num", v if k == 3 else None, None if k == 3 else v) for c, f in cases.items() for k, v in enumerate(f) if v is not None]
    odd = [(99, "k0", "str", None, None), (99, "k1", "num", None, 1.0), (99, "k2", "null", None, None)]
    long = spark.createDataFrame(rows + odd, "case_id long, condition_key string, fact_kind string, b boolean, n double")
    a = {row["case_id"]: row.asDict() for row in evaluate.compiled(rules, wide).collect()}
    b = {(row["case_id"], row["id"]): row["trit"] for row in evaluate.relational(rules, long, wide.select("case_id").unionByName(spark.createDataFrame([(99,)], "case_id long"))).collect()}
    values = lambda f, x: f[int(x[1])]
    for c, f in [*cases.items(), (99, ["text", 1.0, None, None])]:
        t = {x.id: fall(values(f, x.key), values(f, x.minus), x.operator, x.value, x.review) for x in atoms[:6]} | {"flag": 2 if f[3] else 0}
        t["any"] = max(t["p0"], t["p1"], t["flag"])
        t["all"] = t["n"] = min(t["any"], t["p2"], t["p3"])
        t["lost"] = max(t["p4"], 1)
        assert all(b[c, i] == v and (c == 99 or a[c][f"t_{i}"] == v) for i, v in t.items()), (c, f)


def test_deep_rules():
    """A chain of 3,000 composites has heights without recursion."""
    n = 3000
    rules = Rules([Atom("a", "k")], [Composite(f"c{k}", "OR", (f"c{k - 1}" if k else "a",)) for k in range(n)], [], [])
    assert rules.height()[f"c{n - 1}"] == n
