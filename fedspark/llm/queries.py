"""The registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, embedding_dedup, html_extract, language_id, line_dedup, mixing, quality_rules, simhash, token_counts, url_filters
from . import oracles
from .common import read_table

BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The rules of the URL query.
URL_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_with_edits(read_table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good"))
    return quality_rules.filter_by_rules(read_table(spark, sf_dir, "documents"), labels)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    size, copies = F.col("__size"), F.col("__copies")
    return mixed.select("doc_id", size.alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), (size * copies).alias("taken"), copies.alias("copies"), F.col("__rate").alias("rate"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__kept").alias("n_kept"), F.sha2(F.col("__text"), 256).alias("text_sha256"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes: labels whose doc_id is a page_id; a page of low quality or with toxic text is bad."""
    bad = F.greatest(1 - F.col("quality"), F.col("toxic"))
    outcomes = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return url_filters.filter_urls(read_table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predictions(read_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_token_counts, op2_bpe, op3_embedding_dedup, op4_quality_rules, op5_mixing, op6_html_extract, op7_line_dedup, op8_simhash, op9_url_filters, op10_language_id)}


def oracle_sql() -> dict[str, str]:
    return {"op9_url_filters": oracles.URL_FILTERS}
