"""The corpus pipeline: language ID, MinHash near-dedup, suffix-array dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs; run() writes each stage's
result as Parquet and reads it again as the next one's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborix.llm import decontaminate, langid, minhash, packing, suffix_dedup
from arborix.llm.common import Scratch, lean, read
from arborix.llm.queries import _vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose best cosine is lower is in no language that was learned, however short it is; longer ones need what learned texts of their size have.
LEAST_COSINE = 0.03


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; null texts and texts without a letter go too."""
    lean(spark)
    learned = docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) != 1)
    names, protos = langid.fit(learned)
    return langid.keep(docs.select(*COLUMNS), names, protos, langid.floors(learned, names, protos, LEAST_COSINE))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest doc_id.

    Every row is a document of its own, whether its doc_id is null or repeated: rows get keys in a table of their own."""
    scratch = Scratch(spark, "near-dedup")
    rows = scratch.save(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()))
    groups = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")).alias("first")
    stays = rows.select("row", "doc_id").join(groups, "row").groupBy("component_id").agg(first).select("first.row")
    return rows.join(stays, "row", "left_semi").select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without their repeated passages; a character that a cut splits goes."""
    return suffix_dedup.without_repeats(docs.select(*COLUMNS))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; of rows that repeat a doc_id or have none each is judged by its own text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*COLUMNS).withColumn("key", F.struct(F.coalesce("doc_id", F.xxhash64(text, F.lit(1))).alias("k"), F.xxhash64(text).alias("h")))
    found = decontaminate.find(rows.select(F.col("key").alias("doc_id"), "text"), read(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("key")).distinct()
    return rows.join(found, "key", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, _vocabulary("word_bpe_49k.json"))


STAGES = [("language ID", language), ("near-dedup", near_dedup), ("suffix-array dedup", passage_dedup), ("decontamination", decontaminated), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs, before = Scratch(spark, "pipeline"), read(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return docs


#: SQL can express neither the language model nor MinHash, merged transforms and packing.
ORACLE_SQL = None
