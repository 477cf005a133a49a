"""Registered queries of this part: each applies one operator to a whole table and returns the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.llm import (
    bpe, decontamination, filter_audit, html_extraction, language_id, lm_scoring, piece_bpe, quality_rules, sharding, simhash,
    source_divergence, substring_dedup, suffix_array_dedup,
)
from ordermill.llm.oracles import ORACLE


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.dedup(docs, window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.mark(docs, _table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def _remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(-1))


def lm_fold(doc_id: Column) -> Column:
    """Remainder 2 is held out; of the rest, remainder 3 serves to learn the weights before it joins the counts."""
    rest = _remainder(doc_id, 7)
    return F.when(rest == 2, lm_scoring.HELD_OUT).when(rest == 3, lm_scoring.WEIGHTS).otherwise(lm_scoring.LEARN)


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lm_scoring.score(docs, lm_fold(F.col("doc_id")))
    held_out = _remainder(F.col("doc_id"), 7) == 2
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = _remainder(F.col("doc_id"), 3) == 1
    model = language_id.fit(docs.where(~held_out))
    found = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_array_dedup.dedup(docs, length=400, order="doc_id", keep_first=False)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, shingle=3, radius=3).select("doc_id", "fingerprint", "component_id")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Content of a vocabulary file of the box."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode(docs, tokenizer_file(), stable=True, digests=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard(_table(spark, sf_dir, "documents"), ["source", "lang", "n_chars", "doc_id"], shards=8)
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def model_file(name: str = "piece_bpe_32k.model") -> bytes:
    """Content of a SentencePiece model of the box."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = piece_bpe.encode(docs, model_file(), check="stretches", digests=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(_table(spark, sf_dir, "documents").select("text", "lang", "source"), min_docs=3, ranks=200)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_language_id": op4_language_id,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_simhash": op7_simhash,
    "op8_html_extraction": op8_html_extraction,
    "op9_bpe": op9_bpe,
    "op10_sharding": op10_sharding,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_source_divergence": op12_source_divergence,
    "op13_filter_audit": op13_filter_audit,
}

__all__ = ["ORACLE", "QUERIES"]
