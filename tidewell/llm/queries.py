"""One registered query per text operator, over its whole table, with the SQL counterparts that exist."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm import (
    chat_format,
    decontamination,
    html_extraction,
    language_id,
    merkle_manifest,
    packing,
    quality_classifier,
    quality_rules,
    scaled_sketch,
    simhash_dedup,
    spelling_variants,
    substring_dedup,
    token_counts,
)
from tidewell.llm.common import staged, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_counts.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicate_groups(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_digest(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return quality_classifier.quality_scores(docs, table(spark, sf_dir, "labels", ["doc_id", "quality"]))


@query
def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return decontamination.leaked_passages(docs, table(spark, sf_dir, "benchmark", ["item_id", "text"]))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(table(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    turns = table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"])
    return chat_format.read_back(chat_format.formatted(chat_format.with_forged(turns), path), path)


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return quality_rules.judged(docs, table(spark, sf_dir, "labels", ["doc_id", "quality"]))


ORACLE["op4_quality_rules"] = quality_rules.ORACLE


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", ["page_id", "url", "html"])
    return html_extraction.main_texts(pages, staged(html_extraction.wrappers(pages)))


@query
def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.edited(table(spark, sf_dir, "documents", ["doc_id", "text"]))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", ["doc_id", "text"])
    return spelling_variants.variant_groups(spelling_variants.misspelt_words(docs))


ORACLE["op12_spelling_variants"] = spelling_variants.ORACLE


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents", list(merkle_manifest.FIELDS)))


ORACLE["op13_merkle_manifest"] = merkle_manifest.ORACLE
