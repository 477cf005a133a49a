"""Corpus preparation: stages of the llm operators, each written as Parquet and read again for the next.

Quality rules drop texts that are no prose, SimHash leaves one of each group of near copies, suffix arrays cut later
copies of long passages, decontamination drops texts with benchmark passages, and BPE turns what is left into ids.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import bpe, decontamination, quality_rules, simhash, suffix_array_dedup
from ordermill.llm.registry import tokenizer_file
from ordermill.session import scratch_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of passages of 400 bytes; texts of which nothing is left go."""
    left = suffix_array_dedup.without_later_copies(docs, length=400, order="doc_id")
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten words in a row from a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the text that they decode to, in place of the text."""
    return bpe.encode(docs, tokenizer_file("word_bpe_49k.json")).drop("text")


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("benchmark_decontamination", decontaminated),
    ("bpe_encoding", encoded),
]

# Components of fingerprints and BPE are beyond SQL; tests hold run() against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
