"""Definition bundles as rules tables (DEFN-*): one loader for any bundle, its gates, its provenance and the fill of missing atoms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import first_wins


def excerpt_gate(body: Column, required: list[str]) -> Column:
    """FN-33: the required excerpts that the body lacks; the gate is open when there is none."""
    return F.filter(F.array(*[F.lit(r) for r in required]), lambda r: ~F.contains(F.lower(body), F.lower(r)))


def load_bundles(bundles: DataFrame, rules: DataFrame, gates: DataFrame) -> DataFrame:
    """JOIN-10, DEFN-9: rules (bundle, id, position, placeholder) of bundles (bundle, bundle_order), the placeholder rows where the
    bundle's gate (bundle, open) is shut and the others where it is open; the first of a repeated id wins."""
    state = bundles.join(gates, "bundle", "left").withColumn("open", F.coalesce("open", F.lit(False)))
    rows = rules.join(F.broadcast(state), "bundle").where(F.col("placeholder") != F.col("open"))
    order = F.col("bundle_order") * F.lit(1_000_000).cast("long") + F.col("position")
    return first_wins(rows.withColumn("ord", order).drop("open", "bundle_order", "position", "placeholder"), ["id"], "ord")


def fill_missing(leaves: DataFrame, composites: DataFrame, code: str) -> DataFrame:
    """JOIN-9: an atom for each key of leaves (key, position, text) without a composite (key), from the key's first leaf (S4)."""
    first = first_wins(leaves, ["key"], "position")
    fresh = first.join(composites.select("key").distinct(), "key", "left_anti")
    return fresh.select(F.concat(F.lit(f"atom.{code}."), "key").alias("id"), F.col("key").alias("condition_key"), F.lit("atomic_flag").alias("definition_type"), F.lit("IS_TRUE").alias("operator"), F.col("text").alias("original_text"))


def overlay(meta: DataFrame, stub: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """JOIN-11: the stub's values where it has the row, null ones too."""
    s = stub.select(F.col(key).alias("_k"), F.lit(True).alias("_there"), *[F.col(c).alias("_" + c) for c in columns])
    both = meta.join(s, F.col(key) == F.col("_k"), "left")
    return both.select(*[c for c in meta.columns if c not in columns], *[F.when(F.col("_there"), F.col("_" + c)).otherwise(F.col(c)).alias(c) for c in columns])


def orphans(rules: DataFrame, edges: DataFrame, roots: DataFrame) -> DataFrame:
    """VAL-29: rule ids that are neither roots nor children of anything defined."""
    known = edges.select(F.col("id")).unionByName(roots.select("id")).distinct()
    return rules.select("id").join(known, "id", "left_anti")
