"""The tree builder, its dictionary and texts, linkage and envelopes, against rows written by hand."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from arborix.operators import build, envelope

SOURCE = [
    ("r", None, 1, "Admission is indicated for 1 or more of the following: [A]"),
    ("r.ex", "r", 2, "Examples include one of these"),
    ("r.ex.and", "r.ex", 1, "All of the following"),
    ("r.ex.and.1", "r.ex.and", 1, "deep"),
    ("r.ex.leaf", "r.ex", 2, "shallow (3) (4, 5)"),
    ("r.opt", "r", 3, "OPTIONS include care"),
    ("r.opt.1", "r.opt", 1, "care at home"),
    ("r.intro", "r", 4, "Bleeding as indicated by this"),
    ("r.intro.1", "r.intro", 1, None),
    ("r.list", "r", 1, "Plain"),
    *((f"r.list.{k}", "r.list", k, f"item {k}") for k in range(1, 11)),
    ("alone", None, 2, "examples include nothing"),
    ("lost", "nowhere", 1, "x"),
]


@pytest.fixture(scope="module")
def nodes(spark):
    return build.logic_nodes(spark.createDataFrame(SOURCE, "id string, parent string, ord int, text string"), " M-083").cache()


def test_logic_nodes(nodes):
    got = {r["id"]: r for r in nodes.collect()}
    key = lambda i: "leaf_m083_" + hashlib.sha256(i.encode()).hexdigest()[:16]
    kinds = {i: (r["kind"], r["operator"], r["example_only"], r["strict"], r["key"]) for i, r in got.items()}
    want = {"r": ("composite", "OR", False, True, None), "r.ex": ("composite", "EXAMPLE_SET", True, False, None), "r.ex.and": ("composite", "AND", False, True, None), "r.opt": ("composite", "OPTIONS", False, True, None), "r.intro": ("composite", "criteria_intro", False, True, None), "r.list": ("composite", "CHECKLIST", False, True, None)}
    want |= {i: ("atomic", "IS_TRUE", True, False, key(i)) for i in ("r.ex.and.1", "r.ex.leaf")}
    want |= {i: ("atomic", "IS_TRUE", False, True, key(i)) for i in ("r.opt.1", "r.intro.1", "alone", *(f"r.list.{k}" for k in range(1, 11)))}
    assert kinds == want
    assert {i: (r["root"], r["depth"]) for i, r in got.items() if i in ("r", "r.ex.and.1", "alone")} == {"r": ("r", 0), "r.ex.and.1": ("r", 3), "alone": ("alone", 0)}


def test_dictionary(nodes):
    named = nodes.withColumn("domain", F.when(F.col("id").startswith("r.list"), "M083.discharge.list").when(F.col("id").startswith("r.opt"), "M083.discharge.options").otherwise("M083.admission.path.1"))
    got = {r["id"]: (r["condition_key"], r["role"], r["parent_operator"]) for r in build.dictionary(named).collect()}
    assert got["r.ex.and"] == ("r_ex_and_composite", "composite", "EXAMPLE_SET") and got["r"] == ("r_composite", "composite", None)
    assert got["r.opt.1"][1:] == ("option", "OPTIONS") and got["r.list.10"][1:] == ("checklist_item", "CHECKLIST") and got["r.ex.leaf"][1:] == ("atomic_fact", "EXAMPLE_SET")
    context = nodes.where("id = 'r.ex.leaf'").withColumn("kind", F.lit("context")).withColumn("key", F.lit("")).withColumn("domain", F.lit(None).cast("string"))
    assert [tuple(r) for r in build.dictionary(context).collect()] == [("r.ex.leaf", "r_ex_leaf", "context", None)]


def test_indented(nodes):
    """Children stand in their order, the tenth after the ninth."""
    lines = nodes.withColumn("line", build.tree_line(F.col("kind"), F.col("operator"), F.lit(None).cast("string"), F.col("text")))
    got = {r["root"]: r["text"] for r in build.indented(lines).collect()}
    assert got["r"].split("\n") == [
        "[OR] Admission is indicated for 1 or more of the following",
        "  [CHECKLIST] Plain",
        *(f"    [atomic] item {k}" for k in range(1, 11)),
        "  [EXAMPLE_SET] Examples include one of these",
        "    [AND] All of the following",
        "      [atomic] deep",
        "    [atomic] shallow ) )",
        "  [OPTIONS] OPTIONS include care",
        "    [atomic] care at home",
        "  [criteria_intro] Bleeding as indicated by this",
        "    [atomic] ",
    ]
    assert got["alone"] == "[atomic] examples include nothing"


def test_tree_line(spark):
    rows = [("atomic", ">=", "SpO2", "x" * 200), ("atomic", "==", "m", "y"), ("context", "AND", None, "z"), ("composite", None, None, "w")]
    got = spark.createDataFrame(rows, "k string, o string, m string, t string").select(build.tree_line(*(F.col(c) for c in "komt")).alias("l")).collect()
    assert [r["l"] for r in got] == ["[atomic >= SpO2] " + "x" * 172, "[atomic] y", "[context] z", "[] w"]


def test_linkage_summary(spark):
    rows = [("leaf_m1_a", "title one", "unlinked"), ("leaf_m1_b", "other", "unlinked"), ("named", "title one", "linked_shared_definition"), (None, "x", "linked_shared_atomic_definition"), ("leaf_m2_c", "title one", "unlinked")]
    frame = lambda r: spark.createDataFrame(r, "key string, head string, status string")
    titles = spark.createDataFrame([("title one",), ("title one",), ("",)], "head string")
    got = build.linkage_summary(frame(rows), titles, "M1", {"shock": "shock"}).first().asDict()
    assert got == {"leaves": 5, "hashed": 2, "named": 2, "linked": 1, "linked_atomic": 1, "unlinked": 3, "missing": 1, "shock": False, "ready": False}
    ready = lambda r: build.linkage_summary(frame(r), titles, "M1", {"shock": "shock"}).first()["ready"]
    assert ready(rows[1:]) and not ready([*rows[1:], ("leaf_m1_d", "in shock now", "unlinked")]) and ready([])


def of(spark, column, *texts):
    df = spark.createDataFrame([(k, x if x is None or isinstance(x, str) else json.dumps(x)) for k, x in enumerate(texts)], "k int, x string").orderBy("k")
    return [r[0] for r in df.select(column).collect()]


def test_admission(spark):
    cases = [({"rule_engine": {"admission": "y"}}, "YES"), ({"rule_engine": {"admission": "N"}}, "NO"), ({"rule_engine": {"admission": "deny"}}, "NO"), ({"admission": "RECOMMENDED"}, "UNKNOWN"), ({"admission": " yes"}, "UNKNOWN")]
    cases += [({"rule_engine": {"admission": "maybe", "recommendation": True}, "admission": "no"}, "YES"), ({"rule_engine": [], "rule_engine_result": {"admission_decision": "Indeterminate"}, "admission": "met"}, "UNKNOWN")]
    cases += [({"admission": "", "admission_decision": "admit"}, "YES"), ({"admission_recommendation": {"value": None, "status": "NOT_MET"}}, "NO"), ({"admission_recommendation": {"value": "", "status": "YES"}}, "UNKNOWN"), ({"admission_recommendation": "YES"}, "UNKNOWN"), ({}, "UNKNOWN"), (None, "UNKNOWN")]
    assert of(spark, envelope.admission(F.col("x")), *(c for c, _ in cases)) == [w for _, w in cases]


def test_criterion_result(spark):
    rows = [("", "TRUE", True, "UNKNOWN"), (None, "met", False, "TRUE"), (None, None, False, "FALSE"), (None, None, None, "UNKNOWN"), ("matched", None, None, "TRUE"), ("partial", None, None, "PARTIAL"), (None, "", True, "UNKNOWN")]
    got = spark.createDataFrame(rows, "r string, t string, m boolean, w string").select(envelope.criterion_result(F.col("r"), F.col("t"), F.col("m")).alias("g"), "w").collect()
    assert [r["g"] for r in got] == [r["w"] for r in got]


def test_criteria(spark):
    texts = [{"evaluation_rows": [], "evaluations": [1, {"a": 2}]}, {"criteria_evaluations": {"x": 1}, "rule_engine": 3, "deterministic_rule_engine": {"criteria": [], "rows": ["r"]}}, {"evaluation_rows": [None]}, {}, [1], None]
    df = spark.createDataFrame([(k, json.dumps(x) if x is not None else None) for k, x in enumerate(texts)], "k int, x string").select("k", F.try_parse_json("x").alias("v"))
    got = envelope.criteria(df, "v").select("k", "pos", F.to_json("criterion").alias("c")).collect()
    assert sorted(map(tuple, got)) == [(0, 0, "1"), (0, 1, '{"a":2}'), (1, 0, '"r"'), (2, 0, "null")]


def test_selected_module(spark):
    v = F.try_parse_json("x")
    column = envelope.selected_module(v, F.lit("T"), F.lit("Top"), F.create_map(F.lit("C"), F.lit("Of C")))
    got = of(spark, column, {"selected_mcg_code": "C"}, {"selected_module": {"code": 7, "title": None, "name": "N"}, "module": {"title": "M"}}, {"module": {"code": {}, "title": "M"}}, {}, {"selected_mcg_code": ""})
    assert [tuple(x) if x else x for x in got] == [("C", "Of C"), ("7", "N"), ("T", "M"), ("T", "Top"), None]


def test_document_errors(spark):
    good = {k: None for k in envelope.SOURCE_TREE_KEYS} | {"schema_version": envelope.SOURCE_TREE}
    got = of(spark, envelope.document_errors(F.try_parse_json("x")), good, {k: x for k, x in good.items() if k not in ("schema_version", "codes")}, {**good, "schema_version": "v0"})
    assert got == [[], ["schema_version mismatch: None", "missing top-level key: codes"], ["schema_version mismatch: v0"]]
