"""Joins, dedupes, ranks and tree operators over plain tables (JOIN-*, DED-*, RANK-*, TREE-*, SRC-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.package import settled


def pick(df: DataFrame, by: list, order: list) -> DataFrame:
    """First row of each group in the order given, which must name all that decides (S19)."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("_n = 1").drop("_n")


def first_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """JOIN-8, JOIN-10: keeps only the columns of the first row; an aggregate, so that a hot key combines before the shuffle."""
    rest = F.struct(position, *[c for c in df.columns if c not in keys and c != position])
    return df.groupBy(*keys).agg(F.min(rest).alias("r")).select(*keys, "r.*")


def last_wins(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """JOIN-2."""
    rest = F.struct(position, *[c for c in df.columns if c not in keys and c != position])
    return df.groupBy(*keys).agg(F.max(rest).alias("r")).select(*keys, "r.*")


def link_status(definition_type: Column, root_composite: Column, root_atomic: Column) -> Column:
    """JOIN-1: of a left-joined definition."""
    there = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return (
        F.when((definition_type == "shared_composite_condition") & there(root_composite), "linked_shared_definition")
        .when((definition_type == "shared_atomic_condition") & there(root_atomic), "linked_shared_atomic_definition")
        .otherwise("unlinked")
    )


def missing(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """JOIN-4 to JOIN-6, VAL-3: rows of left without a match in right."""
    return left.join(right.select(F.col(right_key).alias("_k")).distinct(), F.col(left_key) == F.col("_k"), "left_anti")


def merge_ordered(df: DataFrame, key: str, position: str, columns: list[str]) -> DataFrame:
    """DED-5: per key the distinct values of each column in first-seen order."""
    rows = F.array_sort(F.collect_list(F.struct(position, *columns)))
    return df.groupBy(key).agg(rows.alias("r")).select(key, *[F.array_distinct(F.col("r")[c]).alias(c + "s") for c in columns])


def top_k(df: DataFrame, by: list[str], order: list, k: int) -> DataFrame:
    """RANK-8."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def walk_down(edges: DataFrame) -> DataFrame:
    """TREE-8, TREE-17, VAL-12 over edges (id, parent): (id, root, depth, ids) from rows without parent; a cycle is not entered.

    A driver loop over levels, however many there are, with one join each. A level is checkpointed, so that the
    next one and the test for its end don't compute those before it again, and plans stay small."""
    level = edges.where("parent IS NULL").select("id", F.col("id").alias("root"), F.lit(0).alias("depth"), F.array("id").alias("ids"))
    out, depth = level, 0
    below = edges.where("parent IS NOT NULL").select(F.col("id").alias("child"), "parent")
    while True:
        depth += 1
        level = settled(level.join(below, level["id"] == below["parent"]).where(~F.array_contains("ids", F.col("child"))).select(F.col("child").alias("id"), "root", F.lit(depth).alias("depth"), F.concat("ids", F.array("child")).alias("ids")))
        if level.isEmpty():
            return out
        out = out.unionByName(level)


def child_index(edges: DataFrame, order: str) -> DataFrame:
    """TREE-1: parent and its children sorted by the order column."""
    return edges.where("parent IS NOT NULL").groupBy("parent").agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "id"))), lambda x: x["id"]).alias("children"))


def url_quality(url: Column, hit: Column, prefix: str, suffix: str) -> Column:
    """RANK-2: additive score of a URL."""
    low = F.lower(url)
    return F.when(low.contains(prefix) & low.endswith(suffix), 100).otherwise(0) + F.when(low.contains("index.htm"), -200).otherwise(0) + F.when(low.contains("toc."), -500).otherwise(0) + F.when(hit, 40).otherwise(0)


def confidence(code_in: Column, title_in: Column, near: Column, clinical: Column) -> Column:
    """RANK-3: high from 5 points, medium from 3."""
    score = (
        F.when(code_in == "link_text", 2).when(code_in.isin("page_title", "page_body"), 1).otherwise(0)
        + F.when(title_in == "h1", 2).when(title_in.isin("page_title", "link_text"), 1).otherwise(0)
        + F.when(near, 2).otherwise(0)
        + F.when(clinical, 1).otherwise(0)
    )
    return F.when(score >= 5, "high").when(score >= 3, "medium").otherwise("low")


def forward_fill(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """PARSE-4: the last heading at or before each line."""
    return df.withColumn(value, F.last(value, ignorenulls=True).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def capture_status(failed: Column, reasons: Column) -> Column:
    """VAL-31: failed before needs_review before pass."""
    return F.when(failed, "failed").when(F.size(reasons) > 0, "needs_review").otherwise("pass")


def ratio(part: Column, whole: Column, places: int = 4) -> Column:
    """AGG-17: half-even rounding, with a denominator of one at least."""
    return F.bround(part / F.greatest(whole, F.lit(1)), places)
