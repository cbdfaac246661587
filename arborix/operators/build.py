"""From source trees to logic nodes, their dictionary, audits and texts (TREE-*, VAL-9, VAL-19, VAL-20, AGG-5 to AGG-13)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import for_hash, logic_hint, strip_marks
from ..sources.package import settled


def ref_registry(source: DataFrame) -> DataFrame:
    """TREE-2 over (id, ord, text): (ref_id, text, first_id, uses), a row for each different text, of its first use; aggregated before the shuffle."""
    h = F.sha2(for_hash(F.col("text")), 256)
    rows = source.groupBy(h.alias("h")).agg(F.min(F.struct("ord", "id", "text")).alias("f"), F.count("*").alias("uses"))
    return rows.select(F.concat(F.lit("sr."), F.substring("h", 1, 14)).alias("ref_id"), F.col("f.text").alias("text"), F.col("f.id").alias("first_id"), "uses")


def leaf_key(code: str, source_id: Column) -> Column:
    """The key of a leaf that no name fits: a hash of its source's id."""
    return F.concat(F.lit(f"leaf_{re.sub('[^a-z0-9]', '', code.strip().lower())}_"), F.substring(F.sha2(source_id, 256), 1, 16))


def logic_nodes(source: DataFrame, code: str) -> DataFrame:
    """TREE-3 to TREE-6 over (id, parent, ord, text): (id, parent, root, depth, place, kind, operator, key, example_only, strict, text).

    A node without children is atomic and tested for truth. Another is composite, with the operator that its text hints at, whatever that is
    (S8); without a hint it is OPTIONS if its text says "options include", else CHECKLIST. What stands anywhere under an example set is an
    example if it is a leaf; a composite is one only by its own operator (S11). `place` orders a tree's nodes as they are entered,
    siblings by (ord, id). The source is read once; each level is one join. Ids are distinct; what no root reaches has no row."""
    text = F.coalesce("text", F.lit(""))
    other = F.when(F.lower(text).contains("options include"), "OPTIONS").otherwise("CHECKLIST")
    inner = source.where("parent IS NOT NULL").select(F.col("parent").alias("id")).distinct().withColumn("inner", F.lit(True))
    rows = source.select("id", "parent", "ord", "text").join(inner, "id", "left").withColumn("inner", F.coalesce("inner", F.lit(False)))
    rows = settled(rows.withColumn("operator", F.when(F.col("inner"), F.coalesce(logic_hint(F.col("text"))["inferred_operator"], other)).otherwise("IS_TRUE")))
    own = F.col("inner") & (F.col("operator") == "EXAMPLE_SET")
    below = rows.where("parent IS NOT NULL")
    level = rows.where("parent IS NULL").select(*rows.columns, F.col("id").alias("root"), F.lit(0).alias("depth"), F.array(F.struct("ord", "id")).alias("place"), F.lit(False).alias("inherited"))
    out = level
    while True:
        above = level.select(F.col("id").alias("parent"), "root", F.col("depth") + 1, F.col("place").alias("_place"), (F.col("inherited") | own).alias("inherited")).toDF("parent", "root", "depth", "_place", "inherited")
        level = settled(below.join(above, "parent").withColumn("place", F.concat("_place", F.array(F.struct("ord", "id")))).select(*out.columns))
        if level.isEmpty():
            break
        out = out.unionByName(level)
    example = F.when(F.col("inner"), own).otherwise(F.col("inherited"))
    return out.select("id", "parent", "root", "depth", "place", F.when(F.col("inner"), "composite").otherwise("atomic").alias("kind"), "operator", F.when(~F.col("inner"), leaf_key(code, F.col("id"))).alias("key"), example.alias("example_only"), (~example).alias("strict"), "text")


def dictionary(nodes: DataFrame, domain: str = "domain") -> DataFrame:
    """TREE-12 over logic nodes with the name of their domain: (id, condition_key, role, parent_operator), a row for each node.

    Composites and contexts are named so; in a discharge domain what stands under OPTIONS is an option and the rest a checklist item; all else is
    an atomic fact. A node without a key has its id with `_` for dots, a composite with `_composite` after it."""
    above = nodes.select(F.col("id").alias("parent"), F.col("operator").alias("parent_operator"))
    discharge = F.coalesce(F.col(domain), F.lit("")).contains("discharge")
    role = F.when(F.col("kind").isin("composite", "context"), F.col("kind")).when(discharge & F.coalesce(F.col("parent_operator") == "OPTIONS", F.lit(False)), "option").when(discharge, "checklist_item").otherwise("atomic_fact")
    named = F.concat(F.replace("id", F.lit("."), F.lit("_")), F.when(F.col("kind") == "composite", "_composite").otherwise(""))
    return nodes.join(above, "parent", "left").select("id", F.coalesce(F.nullif("key", F.lit("")), named).alias("condition_key"), role.alias("role"), "parent_operator")


def hygiene(nodes: DataFrame, synthetic: list[str]) -> DataFrame:
    """TREE-13: (check_id, id) of keys made from sources, examples that are strict, and texts that no source has."""
    bad = F.coalesce(F.col("key").startswith("src_") | F.col("key").contains("source_"), F.lit(False))
    strict = ((F.col("operator") == "EXAMPLE_SET") | F.col("example_only")) & F.coalesce(F.col("strict"), F.lit(True))
    checks = F.array(F.when(bad, "bad key"), F.when(strict, "strict example"), F.when(F.trim("text").isin(*synthetic), "synthetic text"))
    return nodes.select("id", F.explode(F.array_compact(checks)).alias("check_id")).select("check_id", "id")


def tree_line(kind: Column, operator: Column, measurement: Column, text: Column) -> Column:
    """TREE-14: a node's line: its kind or operator in brackets, and 172 characters of its text without marks."""
    op = F.coalesce(operator, F.lit(""))
    tested = F.concat(F.lit("[atomic "), op, F.lit(" "), F.coalesce(measurement, F.lit("")), F.lit("]"))
    head = F.when(kind == "context", "[context]").when((kind == "atomic") & op.isin("<", "<=", ">", ">="), tested).when(kind == "atomic", "[atomic]").otherwise(F.concat(F.lit("["), op, F.lit("]")))
    return F.concat(head, F.lit(" "), F.substring(strip_marks(text), 1, 172))


def indented(nodes: DataFrame) -> DataFrame:
    """TREE-14 over (root, place, depth, line): (root, text), a line for each node in the order of places, indented by its depth; a tree is one row, as its text is one value."""
    line = F.concat(F.repeat(F.lit("  "), F.col("depth")), F.col("line"))
    return nodes.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))).alias("l")).select("root", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("text"))


def logic_checks(nodes: DataFrame, refs: DataFrame) -> DataFrame:
    """VAL-9 over logic nodes with a ref_id: (check_id, id) of nodes with an unknown reference, without text, or with an unknown parent."""
    unknown = nodes.where("ref_id IS NOT NULL").join(refs.select("ref_id"), "ref_id", "left_anti").select(F.lit("unknown reference").alias("check_id"), "id")
    blank = nodes.where(F.trim(F.coalesce("text", F.lit(""))) == "").select(F.lit("no text").alias("check_id"), "id")
    lost = nodes.where("parent IS NOT NULL").join(nodes.select(F.col("id").alias("parent")), "parent", "left_anti").select(F.lit("unknown parent").alias("check_id"), "id")
    return unknown.unionByName(blank).unionByName(lost)


def sentinels(atoms: DataFrame, expected: DataFrame, fields: list[str]) -> DataFrame:
    """VAL-19: (id, field) where an expected atom is missing (field `id`) or differs."""
    got = atoms.select("id", F.lit(True).alias("_here"), *[F.col(f).alias(f"_{f}") for f in fields])
    both = expected.join(got, "id", "left")
    differs = [F.when(F.col("_here") & ~F.col(f).eqNullSafe(F.col(f"_{f}")), f) for f in fields]
    return both.select("id", F.explode(F.array_compact(F.array(F.when(F.col("_here").isNull(), "id"), *differs))).alias("field"))


def root_consistency(conditions: DataFrame) -> DataFrame:
    """VAL-20 over (id, type, root_composite, root_atomic): ids that don't have exactly the root that their type asks for."""
    has = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    good = F.when(F.col("type") == "composite", has(F.col("root_composite")) & ~has(F.col("root_atomic"))).when(F.col("type") == "atomic", has(F.col("root_atomic")) & ~has(F.col("root_composite")))
    return conditions.where(~F.coalesce(good, F.lit(False))).select("id")


def definition_flags(atoms: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """AGG-6: one row of flags, each true if any row has it; false over no rows."""
    return atoms.agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(k) for k, c in flags.items()])


def linkage_summary(rows: DataFrame, titles: DataFrame, code: str, watched: dict[str, str]) -> DataFrame:
    """AGG-9, AGG-13 over leaves (key, head, status) and titles (head) of definitions: counts in one row.

    A leaf with a key made from its source is hashed, another is named. `missing` are hashed leaves whose headline is a definition's title;
    each watched phrase has a flag, true if a hashed leaf's headline holds it. The links are `ready` with none of either."""
    hashed = F.coalesce(F.col("key").startswith(f"leaf_{code.lower()}_"), F.lit(False))
    known = titles.where("head <> ''").select("head").distinct().withColumn("titled", F.lit(True))
    both = rows.join(known, "head", "left")
    count = lambda c: F.count_if(c)
    status = lambda x: count(F.col("status") == x)
    flags = {name: F.coalesce(F.bool_or(hashed & F.col("head").contains(phrase)), F.lit(False)) for name, phrase in watched.items()}
    out = both.agg(F.count("*").alias("leaves"), count(hashed).alias("hashed"), count(~hashed & F.col("key").isNotNull()).alias("named"), status("linked_shared_definition").alias("linked"), status("linked_shared_atomic_definition").alias("linked_atomic"), status("unlinked").alias("unlinked"), count(hashed & F.col("titled")).alias("missing"), *(c.alias(k) for k, c in flags.items()))
    ready = F.col("missing") == 0
    for name in flags:
        ready = ready & ~F.col(name)
    return out.withColumn("ready", ready)


def dashboard(rows: DataFrame, by: str, flags: dict[str, Column], known: Column) -> DataFrame:
    """AGG-7, AGG-8: per group counts of flags, and what is left of the known ones, never below zero."""
    counts = [F.count_if(c).alias(k) for k, c in flags.items()]
    left = F.greatest(F.lit(0).cast("long"), F.count("*") - F.sum(known.cast("long")))
    return rows.groupBy(by).agg(F.count("*").alias("n"), *counts, left.alias("left"))


def stage_rows(rows: DataFrame, stages: list[tuple[str, Column]], by: str) -> DataFrame:
    """ORC-1, ORC-2, ORC-12: (by, reached, halted, errors, ready): stages run in order and halt at the first that fails."""
    reached = F.lit(len(stages))
    for k in range(len(stages) - 1, -1, -1):
        reached = F.when(~F.coalesce(stages[k][1], F.lit(False)), k).otherwise(reached)
    names = F.array(*[F.lit(n) for n, _ in stages])
    halted = F.get(names, reached)
    errors = F.array_compact(F.array(F.when(halted.isNotNull(), F.concat(F.lit("failed: "), halted))))
    return rows.select(by, reached.cast("int").alias("reached"), halted.alias("halted"), errors.alias("errors"), halted.isNull().alias("ready"))


def path_order(paths: DataFrame, domains: list[str]) -> DataFrame:
    """SORT-2 over (group, domain, sort_order, id): a number for each path within its group: the domains in order, then sort_order (null last), then id."""
    place = F.coalesce(F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")), F.lit(0))
    order = [F.when(place == 0, 99).otherwise(place), F.coalesce("sort_order", F.lit(9999)), "id"]
    return paths.withColumn("n", F.row_number().over(Window.partitionBy("group").orderBy(*order)))


def case_report(checked: DataFrame, trace: DataFrame, most: int = 12) -> DataFrame:
    """EVAL-13 over (case_id, passed) and (case_id, ord, id, result): a case's verdict with the first rows of its trace, which the report shows."""
    first = trace.where(F.col("ord") < most).groupBy("case_id").agg(F.array_sort(F.collect_list(F.struct("ord", "id", "result"))).alias("t"))
    shown = F.transform("t", lambda x: F.concat_ws(" ", x["id"], x["result"]))
    return checked.join(first, "case_id", "left").select("case_id", "passed", F.array_join(F.coalesce(shown, F.array().cast("array<string>")), "; ").alias("shown"))
