"""One query for each operator, with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import alignment, decontaminate, divergence, html_text, langid, licenses, minhash, packing, quality, suffix_dedup, token_counts, vector_graph, warc
from .common import read


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_html_text(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


def op2_token_counts(spark, sf_dir):
    return token_counts.count(read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), _pattern())


def op3_decontaminate(spark, sf_dir):
    return decontaminate.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_license_scan(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark, sf_dir):
    return suffix_dedup.dedup(read(spark, sf_dir, "documents")).drop("kept")


def op6_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op7_minhash(spark, sf_dir):
    return minhash.near_duplicates(read(spark, sf_dir, "documents"))


def op8_packing(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op9_vector_graph(spark, sf_dir):
    return vector_graph.near_duplicates(read(spark, sf_dir, "embeddings"))


def op10_language_id(spark, sf_dir):
    return langid.identify(read(spark, sf_dir, "documents"))


def op11_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))


def op12_warc(spark, sf_dir):
    return warc.round_trip(read(spark, sf_dir, "pages"))


def op13_alignment(spark, sf_dir):
    return alignment.align(read(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), _pattern(), _vocabulary("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_html_text, op2_token_counts, op3_decontaminate, op4_license_scan, op5_suffix_dedup, op6_quality, op7_minhash, op8_packing, op9_vector_graph, op10_language_id, op11_source_divergence, op12_warc, op13_alignment)}
SQL = {"op3_decontaminate": decontaminate.SQL, "op11_source_divergence": divergence.SQL, "op12_warc": warc.SQL}
