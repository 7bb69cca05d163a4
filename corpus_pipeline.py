"""A corpus pipeline of text operators: each stage works on all that the one before it kept.

Quality classifier, near-dedup, substring dedup, benchmark decontamination, packing. All stages but the last return
the columns of ``documents``. Rows with a null doc_id pass the dedup stages unchanged.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.llm import decontamination, packing, quality_classifier, simhash_dedup, substring_dedup
from tidewell.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.keep_good(docs.select(*COLUMNS), table(spark, sf_dir, "labels", ["doc_id", "quality"]))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays whose fingerprints of three-word shingles are linked by at most two differing bits."""
    return simhash_dedup.keep_one(docs.select(*COLUMNS))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that an earlier document already has in a window of 13 are cut out; the words left are joined by a space."""
    docs = docs.select(*COLUMNS)
    cut = substring_dedup.without_spans(docs, substring_dedup.repeated_spans(docs.select("doc_id", "text")))
    text = F.coalesce("kept_text", "text")
    length = F.when(F.col("kept_text").isNull(), F.col("n_chars")).otherwise(F.length("kept_text").cast("bigint"))
    return cut.withColumns({"n_chars": length, "text": text}).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.without_leaks(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark", ["item_id", "text"]))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in context windows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-dedup", near_dedup),
    ("substring dedup", substrings),
    ("benchmark decontamination", decontaminate),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained classifier, hashing and a tokenizer, which SQL does not express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents", COLUMNS)
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs
