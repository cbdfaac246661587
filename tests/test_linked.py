"""Linked references, record unions and link policies against their DuckDB forms and against rows written by hand."""

import duckdb
import pytest

from arborix.operators import linked as o
from arborix.plans import catalog, linked

DATA = "/root/testdata/sf0.001"
NAMES = [n for n, f in catalog.QUERIES.items() if f.__module__ == linked.__name__]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    duck = duckdb.connect()
    for x in "nation customer orders part lineitem documents pages".split():
        duck.execute(f"CREATE VIEW {x} AS SELECT * FROM '{DATA}/{x}.parquet'")
    got = catalog.QUERIES[name](spark, DATA)
    want = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in got.collect())
    assert rows and rows == sorted(str(r) for r in want.fetchall())


def test_records(spark):
    a = spark.createDataFrame([(1, "definition"), (2, None), (3, "citation")], "id int, popup_type string")
    b = spark.createDataFrame([("definition", "t"), ("x", "u")], "popup_type string, title string")
    assert sorted(map(str, o.records(a, b, only="definition").select("source", "id", "title").collect())) == ["Row(source=0, id=1, title=None)", "Row(source=1, id=None, title='t')"]
    assert o.records(a, b).count() == 5 and o.records(None, b).count() == 2
    with pytest.raises(ValueError):
        o.records(None, None)


NODE = "code string, position int, logic_node_id string, condition_key string, linked_domain_node_id string, definition_link_status string, root string"


def test_policies(spark):
    nodes = [("A", 1, "n1", "k", "adm.1", "unlinked", None), ("A", 2, "n2", "k", "dis.1", "odd", None), ("A", 3, "n3", "  ", "adm.1", "odd", None), ("A", 4, "n4", "k", "adm.2", None, None), ("B", 5, "n5", "k", "adm.1", "unlinked", None), ("B", 6, "n6", "k", "adm.1", "odd", None), (None, 7, "n7", "k", "adm.1", "odd", None), ("A", 8, "n8", None, "adm.1", "odd", None)]
    df = spark.createDataFrame(nodes, NODE)
    policies = spark.createDataFrame([("A", "adm.", ["linked"]), (None, "adm.", ["linked"]), (None, "adm.", ["unlinked"])], "code string, prefix string, allowed array<string>")
    assert sorted(r["entity_id"] for r in o.allowed_statuses(df, policies).collect()) == ["n1", "n4", "n6", "n7"]
    assert sorted(r["entity_id"] for r in o.allowed_statuses(df, policies.where("code is not null")).collect()) == ["n1", "n4"]


def test_required(spark):
    nodes = [("A", 2, "n2", "k", "p2", "linked", "r2"), ("A", 1, "n1", "k", "p1", "linked", "r1"), ("A", 0, "n0", "k", "p0", "unlinked", "r0"), ("B", 1, "m1", "k", "p1", "unlinked", "r1"), ("D", 1, "q1", "k", "p1", "linked", "r1"), ("E", 1, "e1", "k", None, "linked", None)]
    df = spark.createDataFrame(nodes, NODE)
    want = spark.createDataFrame([(c, "k", "linked", "r1", "path") for c in "ABCDE"] + [("A", "k", "linked", None, None)], "code string, condition_key string, status string, root string, node_type string")
    domain = spark.createDataFrame([("A", "p1", "path"), ("A", "p2", "path"), ("B", "p1", "path"), ("E", "p1", "path")], "code string, node_id string, node_type string")
    got = sorted((r["code"], r["message"]) for r in o.required_links(df, want, domain).collect())
    assert got == [("B", "not linked"), ("B", "other root"), ("C", "no node"), ("C", "not linked"), ("C", "other root"), ("D", "no domain tree"), ("E", "not on a path"), ("E", "other root")]
