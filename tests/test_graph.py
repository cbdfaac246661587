"""Numbers, paths, occurrences and crawls against their DuckDB forms and against walks by hand."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from arborix.operators import graph as g
from arborix.plans import catalog, graph

DATA = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == graph.__name__]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem pages".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted((str(tuple(r[c] for c in columns)) for r in got.collect()))
    assert rows and rows == sorted(str(r) for r in want.fetchall())


def test_prefix_sums(spark):
    r = random.Random(3)
    rows = [(k, "hot" if k % 3 else r.choice("abc"), r.randrange(5)) for k in range(300)] + [(300, None, 7), (301, None, 1)]
    rows = [x for x in rows if x[1] is not None]
    got = g.prefix_sums(spark.createDataFrame(rows, "k long, by string, v long"), ["by"], ["k"], "v", "s").collect()
    assert len(got) == len(rows) and all(x["s"] == sum(v for k, b, v in rows if b == x["by"] and k < x["k"]) for x in got)
    got = g.numbered(spark.createDataFrame(rows, "k long, by string, v long"), ["v", "k"], "n").collect()
    assert [x["k"] for x in sorted(got, key=lambda x: x["n"])] == [k for k, _, v in sorted(rows, key=lambda x: (x[2], x[0]))]


#: id, parent, ord: ten children whose ids sort otherwise as text, three levels, a lone root, and a cycle that hangs on no root.
TREE = [("a", None, 0)] + [(f"a{k}", "a", k) for k in range(1, 11)] + [("x", "a2", 2), ("y", "a2", 1), ("z", "x", None), ("w", "x", 0), ("b", None, 1), ("c1", "c2", 0), ("c2", "c1", 0)]


def test_tour_numbers(spark):
    got = {r["id"]: (r["root"], r["depth"], r["size"], r["pre"], r["post"]) for r in g.tour_numbers(spark.createDataFrame(TREE, "id string, parent string, ord int")).collect()}
    want = {"a": ("a", 0, 15, 0, 14), "a1": ("a", 1, 1, 1, 0), "a2": ("a", 1, 5, 2, 5), "y": ("a", 2, 1, 3, 1), "x": ("a", 2, 3, 4, 4), "z": ("a", 3, 1, 5, 2), "w": ("a", 3, 1, 6, 3), "b": ("b", 0, 1, 0, 0)}
    want |= {f"a{k}": ("a", 1, 1, k + 4, k + 3) for k in range(3, 11)}
    assert got == want
    roots = spark.createDataFrame([("a", "adm.root", "adm"), ("b", "only", "q")], "root string, root_id string, prefix string")
    ids = {r["id"]: (r["logic_id"], r["sort_order"]) for r in g.logic_ids(spark.createDataFrame(TREE, "id string, parent string, ord int"), roots).collect()}
    assert ids["a"] == ("adm.root", 14) and ids["a1"] == ("adm.1", 0) and ids["x"] == ("adm.4", 4) and ids["a10"] == ("adm.14", 13) and ids["b"] == ("only", 0)
    assert g.tour_numbers(spark.createDataFrame([], "id string, parent string, ord int")).count() == 0
    assert [tuple(r) for r in g.tour_numbers(spark.createDataFrame([("s", None, 1)], "id string, parent string, ord int")).collect()] == [("s", None, "s", 0, 1, 0, 0)]


def test_discover_paths(spark):
    s = "M1.section.admission"
    rows = [("M1", s, "r1", None, 2, "Some text"), ("M1", s, "r2", None, 3, "Admission is INDICATED for the following"), ("M1", s, "r3", None, 4, "admission is indicated: 1 or more"), ("M1", "M1.section.discharge", "r0", None, 1, "Admission is indicated, following")]
    rows += [("M1", s, "i1", "r2", 2, "one"), ("M1", s, "i2", "r2", 1, None), ("M1", s, "i3", "r2", 3, "Extended Stay"), ("M1", s, "i1", "r2", 9, "again"), ("M1", s, "i5", "r1", 0, "other header"), ("M1", s, "deep", "i1", 0, "below")]
    rows += [("M2", "M2.section.admission", "q1", None, None, None), ("M2", "M2.section.admission", "q2", None, 1, "x"), ("M2", "", "j", "q1", None, "kept"), ("M3", "M3.section.admission", "lone", None, 1, "no items")]
    got = g.discover_paths(spark.createDataFrame(rows, "code string, section string, id string, parent string, ord int, text string")).collect()
    assert sorted(map(tuple, got)) == [("M1", "i1", 2), ("M1", "i2", 1), ("M2", "j", 1)]


def test_occurrences(spark):
    nodes = [("domain", "r", "Root"), ("domain", "a", "A"), ("domain", "b", None), ("shared", "s", "S"), ("shared", "a", "shared A")]
    edges = [("domain", "r", "domain", "a", 1), ("domain", "r", "domain", "b", 2), ("domain", "b", "domain", "a", 1), ("domain", "a", "domain", "r", 2), ("domain", "a", "shared", "s", 1), ("domain", "b", "domain", "gone", 3), ("shared", "s", "shared", "a", 1), ("shared", "a", "shared", "s", 1), ("shared", "a", "shared", "lost", 2)]
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = g.occurrences(t(nodes, "graph string, id string, label string"), t(edges, "graph string, parent string, to_graph string, child string, pos int"), t([("domain", "r", 0), ("domain", "none", 1)], "graph string, id string, pos int")).collect()
    lines = ["  " * r["depth"] + r["line"] for r in sorted(got, key=lambda r: r["place"])]
    box = ["S", "  shared A", "    Shared cycle skipped: s", "    Missing shared child: lost"]
    assert lines == ["Root", "  A", *("    " + x for x in box), "    Cycle skipped: r", "  ", "    A", *("      " + x for x in box), "      Cycle skipped: r", "    Missing logic node: gone", "Missing logic node: none"]


def by_hand(nodes, edges, roots):
    """One occurrence after the other."""
    labels, rows = {(g, i): x or "" for g, i, x in nodes}, []
    stack = [(i, (p,), 0, (), g, i) for g, i, p in roots]
    while stack:
        root, place, depth, above, graph, i = stack.pop()
        kind = "cycle" if i in above else "node" if (graph, i) in labels else "missing"
        rows.append((root, place, depth, graph, i, kind, labels[graph, i] if kind == "node" else g.MARKERS[graph][kind == "missing"] + i))
        if kind == "node":
            stack += [(root, (*place, p), depth + 1, (*above, i) if to == graph else (), to, c) for a, b, to, c, p in edges if (a, b) == (graph, i)]
    return sorted(rows)


def test_occurrences_of_random_graphs(spark):
    """Cycles, missing nodes and several ways into the same shared nodes: as by hand, and so are the counts."""
    r = random.Random(4)
    nodes = [(x, f"{x[0]}{k}", r.choice([None, f"{x} {k}"])) for x in ("domain", "shared") for k in range(9) if k < 6 or r.random() < 0.7]
    edges = [(x, f"{x[0]}{k}", x, f"{x[0]}{r.randrange(9)}", n) for x in ("domain", "shared") for k in range(9) for n in range(r.randrange(1, 3))]
    edges += [("domain", f"d{k}", "shared", f"s{r.randrange(9)}", 9 + n) for k in range(9) for n in range(r.randrange(3))]
    roots = [("domain", "d0", 0), ("domain", "d1", 1), ("shared", "s2", 2), ("domain", "gone", 3)]
    want = by_hand(nodes, edges, roots)
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = t(nodes, "graph string, id string, label string"), t(edges, "graph string, parent string, to_graph string, child string, pos long"), t(roots, "graph string, id string, pos long")
    got = sorted((x["root"], tuple(x["place"]), *x[2:]) for x in g.occurrences(*tables).collect())
    assert got == want and len(want) > 80 and {x[5] for x in want} == {"node", "cycle", "missing"}
    counts = {}
    for root, _, depth, graph, _, kind, _ in want:
        d, n = counts.get((root, graph, kind), (0, 0))
        counts[root, graph, kind] = max(d, depth), n + 1
    assert {(x["root"], x["graph"], x["kind"]): (x["deepest"], x["n"]) for x in g.occurrence_counts(*tables).collect()} == counts


def test_what_a_crossing_leads_into_is_stored_once(spark, tmp_path, monkeypatch):
    """Of 50 crossings into one node with 40 below it, nothing is kept for each crossing and each node below."""
    kept = []

    def counted(keep):
        return lambda df: kept.append((out := keep(df)).count()) or out

    for name in ("settled", "stored"):
        if hasattr(g, name):
            monkeypatch.setattr(g, name, counted(getattr(g, name)))
    nodes = [("domain", "r", "")] + [("domain", f"d{k}", "") for k in range(50)] + [("shared", f"s{k}", "") for k in range(10)]
    edges = [("domain", "r", "domain", f"d{k}", k) for k in range(50)] + [("domain", f"d{k}", "shared", f"s{n}", n) for k in range(50) for n in range(10)]
    edges += [("shared", f"s{k}", "shared", f"s{n}", n) for k in range(10) for n in (k + 1, k + 2) if n < 10]
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = t(nodes, "graph string, id string, label string"), t(edges, "graph string, parent string, to_graph string, child string, pos long"), t([("domain", "r", 0)], "graph string, id string, pos long")
    ways = [1, 2]
    for _ in range(8):
        ways.append(1 + ways[-1] + ways[-2])
    assert g.occurrences(*tables).count() == 51 + 50 * sum(ways) and sum(kept) < 3000 < 50 * sum(ways)
    kept.clear()
    assert {(x["graph"], x["n"]) for x in g.occurrence_counts(*tables).collect()} == {("domain", 51), ("shared", 50 * sum(ways))} and sum(kept) < 3000


def test_crossings_there_and_back(spark):
    """A node that is entered twice on one way, with two crossings."""
    nodes = [(x, i, i) for x, i in (("domain", "r"), ("domain", "a"), ("shared", "s"), ("shared", "u"), ("domain", "z"))]
    edges = [("domain", "r", "shared", "s", 1), ("domain", "r", "shared", "u", 2), ("shared", "u", "domain", "a", 1), ("shared", "s", "domain", "z", 4), ("domain", "a", "shared", "s", 3), ("domain", "a", "shared", "s", 5)]
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    got = g.occurrences(t(nodes, "graph string, id string, label string"), t(edges, "graph string, parent string, to_graph string, child string, pos long"), t([("domain", "r", 0)], "graph string, id string, pos long")).collect()
    assert sorted((x["root"], tuple(x["place"]), *x[2:]) for x in got) == by_hand(nodes, edges, [("domain", "r", 0)])


def crawl_by_hand(links, starts, most, most_leaves):
    """First in, first out, one page after the other."""
    queue, seen, leaves = [(u, 0, None) for u in starts], {}, {}
    order = []
    while queue and len(order) < most:
        url, step, parent = queue.pop(0)
        if url in seen:
            continue
        seen[url] = (step, parent)
        order.append(url)
        for _, dst, leaf in sorted((p, d, x) for s, d, p, x in links if s == url):
            if leaf:
                leaves.setdefault(dst, (step + 1, url))
            else:
                queue.append((dst, step + 1, url))
    return [(u, *seen[u], n) for n, u in enumerate(order)], [(u, *v, n, n < most_leaves) for n, (u, v) in enumerate(leaves.items())]


@pytest.mark.parametrize(("most", "most_leaves"), [(1000, 1000), (7, 3), (1, 0)])
def test_crawl(spark, most, most_leaves):
    r = random.Random(5)
    links = [(f"u{a}", (f"u{r.randrange(40)}" if r.random() < 0.7 else f"leaf{r.randrange(9)}"), k) for a in range(30) for k in range(r.randrange(4))]
    links = [(s, d, p, d.startswith("leaf")) for s, d, p in links]
    df = spark.createDataFrame([*links, (None, "u1", 0, False), ("u1", None, 9, True)], "src string, dst string, pos int, leaf boolean")
    got = g.crawl(df, spark.createDataFrame([("u0", 1), ("u3", 0), ("u0", 5), (None, 0)], "url string, pos int"), most, most_leaves).collect()
    pages, leaves = crawl_by_hand(links, ["u3", "u0"], most, most_leaves)
    assert sorted((x["url"], x["round"], x["parent"], x["n"]) for x in got if x["kind"] == "page" and x["taken"]) == sorted(pages)
    assert sorted((x["url"], x["round"], x["parent"], x["n"], x["taken"]) for x in got if x["kind"] == "leaf") == sorted(leaves)
    assert {x["url"] for x in got if x["kind"] == "page" and not x["taken"]} <= {d for s, d, _, x in links if not x} | {"u0"}
