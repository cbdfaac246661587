"""Every query of the guideline module against its DuckDB form, and its functions on odd input."""

import duckdb
import pytest
from pyspark.sql import functions as F

from arborix.functions import guideline as g
from arborix.operators import build, tables
from arborix.plans import catalog, guideline

DATA = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == guideline.__name__]


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_walk_down_is_deep(spark):
    """No depth is too deep, and a cycle isn't entered."""
    rows = [("0", None), *((str(k), str(k - 1)) for k in range(1, 103)), ("x", "y"), ("y", "x")]
    got = {r["id"]: r["depth"] for r in tables.walk_down(spark.createDataFrame(rows, "id string, parent string").coalesce(1)).select("id", "depth").collect()}
    assert got == {str(k): k for k in range(103)}


def test_odd_text(spark):
    df = spark.createDataFrame([(None,), ("",), ("a | | b|c|d|e",), ("var collapseExpandMap = {};",)], "x string")
    rows = df.select(g.pipe_fields(F.col("x")).alias("p"), g.collapse_map(F.col("x")).alias("m"), g.popup_body(F.col("x")).alias("b"), g.blocked(F.col("x")).alias("h"), g.only_codes(F.col("x")).alias("c")).collect()
    assert [tuple(r["p"]) for r in rows][:3] == [("", "", "", ""), ("", "", "", ""), ("a", "b", "c", "d | e")]
    assert all(r["m"] == {} and r["b"] == "" for r in rows) and rows[0]["c"] is None and rows[1]["h"] is None


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id string, parent string, text string, ord int")
    assert build.logic_nodes(none, "x").count() == build.ref_registry(none).count() == 0
    assert build.definition_flags(none, {"any": F.col("ord") > 0}).first()["any"] is False


def test_deep_and_wide_pages():
    """A list nested 3,000 deep and a list of 20,000 items are parsed without recursion or rescans."""
    import time

    from arborix.operators import html_nodes

    began = time.time()
    for page, n in (("<ul><li>x" * 1500, 1500), ("<ul>" + "<li>y</li>" * 20_000 + "</ul>", 20_000)):
        rows = [r for r in html_nodes.records(f"<html><body><h2>t</h2>{page}</body></html>") if r[0] == "item"]
        assert len(rows) == n
    assert time.time() - began < 60
