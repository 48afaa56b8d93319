"""One query per operator, with production parameters, over its whole table; and DuckDB SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import code_compression, decontaminate, html_extract, jaccard_join, language_id, odd_sketch, quality_knn, quality_rules, warc, whitening
from .common import held_out, table
from .packing import Capacity, pack, pieces
from .pii import personal_data
from .token_counts import section_token_counts


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_knn.score(docs, quality_knn.fit(docs, table(spark, sf_dir, "labels")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return section_token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="first")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    counts = quality_rules.ngram_counts(quality_rules.trusted(docs, table(spark, sf_dir, "labels")))
    return quality_rules.score(docs, quality_rules.log_ratios(counts))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.fit(pages))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), max_tokens=2048), Capacity())


def op6_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict(docs, language_id.fit(docs)).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.transform(vectors, whitening.fit(vectors)).withColumn("deviation", F.col("deviation").cast("long"))


def op12_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_compression.report(table(spark, sf_dir, "embeddings"))


def op13_odd_sketch_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_copies(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_neighbours": op1_quality_neighbours,
    "op2_token_counts": op2_token_counts,
    "op3_quality_rules": op3_quality_rules,
    "op4_html_extraction": op4_html_extraction,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_pii_bootstrap": op6_pii_bootstrap,
    "op7_warc_round_trip": op7_warc_round_trip,
    "op8_language_id": op8_language_id,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_decontamination": op10_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_code_compression": op12_code_compression,
    "op13_odd_sketch_near_copies": op13_odd_sketch_near_copies,
}
ORACLE_SQL: dict[str, str] = {"op7_warc_round_trip": warc.ORACLE, "op9_ngram_jaccard_join": jaccard_join.ORACLE, "op10_decontamination": decontaminate.ORACLE, "op12_code_compression": code_compression.oracle(), "op13_odd_sketch_near_copies": odd_sketch.ORACLE}
