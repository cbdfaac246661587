"""Connected components by alternating large and small stars; every round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(id, component) of every id in edges (a, b): the smallest id that its links reach. Loops and repeats do no harm."""
    now = scratch.save(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u != v").distinct()
        new = scratch.save(small)
        state = tuple(new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        scratch.drop(now)
        now = new
        if state == before:
            break
        before = state
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("id"), "component").unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
