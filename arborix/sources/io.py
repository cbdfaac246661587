"""Readers and writers (SRC-*, SNK-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def json_documents(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """SRC-1: whole JSON documents."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    """SRC-2: blank lines are skipped; the schema is given, not inferred."""
    return spark.read.schema(schema).json(path)


def optional_json(spark: SparkSession, manifest: DataFrame, pattern: str) -> DataFrame:
    """SRC-3: (path, value, error) for each path of the manifest; error is missing, invalid_json or expected_object_got, else null."""
    files = spark.read.format("binaryFile").load(pattern).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), F.decode("content", "UTF-8").alias("value"))
    both = manifest.select("path").join(files, "path", "left")
    kind = F.schema_of_variant(F.try_parse_json("value"))
    error = F.when(F.col("value").isNull(), "missing").when(F.try_parse_json("value").isNull(), "invalid_json").when(~kind.startswith("OBJECT"), "expected_object_got")
    return both.select("path", F.when(error.isNull(), F.col("value")).alias("value"), error.alias("error"))


def html_files(spark: SparkSession, pattern: str) -> DataFrame:
    """SRC-4: (path, html, sha256), the hash over the bytes; bytes that aren't UTF-8 become replacement characters."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.select("path", F.expr("decode(content, 'UTF-8')").alias("html"), F.sha2("content", 256).alias("sha256"))


def manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-5, SRC-6: (entries, violations); an unknown status becomes canonical, an entry without code or url or of a search page is a violation."""
    rows = json_documents(spark, path, "code string, url string, url_status string")
    status = F.when(F.col("url_status").isin("canonical", "search_page"), F.col("url_status")).otherwise("canonical")
    rows = rows.withColumn("url_status", status)
    bad = F.when(F.coalesce(F.trim("code"), F.lit("")) == "", "no code").when(F.coalesce(F.trim("url"), F.lit("")) == "", "no url").when(F.col("url_status") == "search_page", "search page")
    return rows.where(bad.isNull()), rows.withColumn("message", bad).where("message IS NOT NULL")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: lines that aren't blank, for each file."""
    return spark.read.text(path).groupBy(F.input_file_name().alias("path")).agg(F.count_if(F.trim("value") != "").alias("n"))


def write_jsonl(df: DataFrame, path: str) -> None:
    """SNK-1."""
    df.write.mode("overwrite").json(path)


def write_documents(df: DataFrame, key: str, path: str) -> None:
    """SNK-2: one JSON document for each key, with its rows in an array; a document's rows must fit one task, as one document does."""
    df.groupBy(key).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct(*[c for c in df.columns if c != key]))).alias("rows"))).alias("value")).write.mode("overwrite").partitionBy(key).text(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """SNK-3, SNK-4, FN-47: fixed column order, null as empty, booleans as true and false."""
    df.select(*columns).write.mode("overwrite").option("header", True).option("nullValue", "").csv(path)
