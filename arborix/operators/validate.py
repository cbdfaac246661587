"""Violation queries (VAL-*): each gives (check_id, entity_id, message), no row when all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, key: list[str], check: str) -> DataFrame:
    """VAL-2, VAL-15, AGG-3."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(check).alias("check_id"), F.concat_ws("|", *key).alias("entity_id"), F.concat(F.lit("repeated "), "n").alias("message"))


def foreign(left: DataFrame, key: str, right: DataFrame, right_key: str, entity: str, check: str) -> DataFrame:
    """VAL-3, VAL-7, VAL-11, VAL-23."""
    known = right.select(F.col(right_key).alias("_k")).distinct()
    bad = left.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_k"), "left_anti")
    return bad.select(F.lit(check).alias("check_id"), F.col(entity).cast("string").alias("entity_id"), F.concat(F.lit("no "), F.col(key).cast("string")).alias("message"))


def rule(df: DataFrame, bad: Column, entity: str, check: str, message: str) -> DataFrame:
    """VAL-14, VAL-16 to VAL-18, VAL-27: rows for which bad holds; null doesn't."""
    return df.where(F.coalesce(bad, F.lit(False))).select(F.lit(check).alias("check_id"), F.col(entity).cast("string").alias("entity_id"), F.lit(message).alias("message"))


def depth(df: DataFrame, check: str = "depth") -> DataFrame:
    """VAL-4 over (id, parent, depth): roots have 1, others their parent's and one more."""
    parents = df.select(F.col("id").alias("_p"), F.col("depth").alias("_d"))
    both = df.join(parents, F.col("parent") == F.col("_p"), "left")
    want = F.when(F.col("parent").isNull(), 1).otherwise(F.col("_d") + 1)
    return both.where(~F.col("depth").eqNullSafe(want)).select(F.lit(check).alias("check_id"), F.col("id").cast("string").alias("entity_id"), F.concat(F.lit("depth "), F.col("depth").cast("string")).alias("message"))


def reachable(nodes: DataFrame, walked: DataFrame, check: str = "reachable") -> DataFrame:
    """VAL-12: ids that no walk from a root comes to."""
    return nodes.select("id").join(walked.select("id").distinct(), "id", "left_anti").select(F.lit(check).alias("check_id"), F.col("id").cast("string").alias("entity_id"), F.lit("not reachable").alias("message"))


def listed(nodes: DataFrame, check: str = "parent lists child") -> DataFrame:
    """VAL-13 over (id, parent, children)."""
    own = nodes.select(F.col("id").alias("_p"), F.col("children").alias("_c"))
    both = nodes.join(own, F.col("parent") == F.col("_p"))
    return both.where(~F.coalesce(F.array_contains("_c", F.col("id")), F.lit(False))).select(F.lit(check).alias("check_id"), F.col("id").cast("string").alias("entity_id"), F.lit("not in the parent's list").alias("message"))


def arity(nodes: DataFrame, check: str = "arity") -> DataFrame:
    """VAL-10 over (id, operator, children): a known operator, and two children for AND and OR."""
    op = F.col("operator")
    given = op.isNotNull() & (op != "")
    bad = given & (~op.isin("AND", "OR", "CHECKLIST", "OPTIONS", "EXAMPLE_SET") | (op.isin("AND", "OR") & (F.coalesce(F.size("children"), F.lit(0)) < 2)))
    return rule(nodes, bad, "id", check, "operator or arity")


def agrees(stated: DataFrame, counted: DataFrame, check: str = "audit") -> DataFrame:
    """VAL-21, VAL-26 over (metric, value)."""
    both = stated.join(counted.withColumnRenamed("value", "_v"), "metric", "left")
    return both.where(~F.col("value").eqNullSafe(F.col("_v"))).select(F.lit(check).alias("check_id"), F.col("metric").alias("entity_id"), F.lit("differs from the recount").alias("message"))


def together(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)
