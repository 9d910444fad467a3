"""The registered queries of the operators, thin over the operators themselves."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, importance, language_id, mixing, oracles, packing, quality_model, quality_rules, simhash, substring_dedup, suffix_dedup, warc, whitening, winnowing


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_pairs(_read(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per removed span: the document, where the span is (in words), its kind, a document that
    keeps an earlier copy, and the cluster of documents that removals connect."""
    found = substring_dedup.removals(_read(spark, sf_dir, "documents"))
    return substring_dedup.clusters(found).select("doc_id", "start", "stop", "kind", "kept_doc_id", "cluster_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = simhash.simhash_groups(_read(spark, sf_dir, "documents"))
    return d.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality_rules.apply_policy(quality_rules.ledger(_read(spark, sf_dir, "documents"), "doc_id"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_bits")


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels.where(quality_model.crc_mod(3) != 1))
    held_out = (quality_model.crc_mod(3) == 1).alias("held_out")
    return quality_model.score(docs, model, "doc_id").select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(_read(spark, sf_dir, "pages"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    same = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", same), (-1, 1, "assistant", same)], "conv_id long, turn long, role string, text string")
    return chat.round_trip(d.unionByName(own))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(quality_model.crc_mod(4) != 2))
    held_out = (quality_model.crc_mod(4) == 2).alias("held_out")
    return language_id.predict(docs, model, "doc_id").select("doc_id", held_out, "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = mixing.sized(_read(spark, sf_dir, "documents")).withColumn("text_hash", F.xxhash64("text"))
    d = d.select("doc_id", "size", mixing.single_source().alias("sources"), "text_hash")
    return mixing.mix(d, carry=("text_hash",)).select("doc_id", "size", "source_size", "target", "taken")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = suffix_dedup.dedup(_read(spark, sf_dir, "documents"))
    lost = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return d.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_winnowing": op2_winnowing,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_simhash": op4_simhash,
    "op5_quality_rules": op5_quality_rules,
    "op6_quality_model": op6_quality_model,
    "op7_warc": op7_warc,
    "op8_chat": op8_chat,
    "op9_language_id": op9_language_id,
    "op10_mixing": op10_mixing,
    "op11_importance": op11_importance,
    "op12_suffix_dedup": op12_suffix_dedup,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = oracles.SQL
