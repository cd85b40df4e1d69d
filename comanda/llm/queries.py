"""The queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import (
    byte_bpe, conversation_repair, decontaminate, license_scan, lm_scoring, mixing, pii, quality_rules, secret_scan, simhash_dedup,
    suffix_dedup, toxicity, whitening,
)
from comanda.llm.text import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "windows", "worst_word")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("rejected_by", ",").alias("rejected_by"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.recognise(table(spark, sf_dir, "documents"), license_scan.known_sentences(spark))
    rules = F.array_join(F.sort_array(F.transform("rules", lambda r: r.cast("string"))), ",")
    return found.select("doc_id", "licence", rules.alias("rules"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return mixed.select("doc_id", "n_tokens", *(f"p_{name}" for name in mixing.DOMAINS), "rate")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = {kind: i for i, kind in enumerate(secret_scan.KINDS)}
    base = F.filter("spans", lambda s: s["kind"] != kinds["random"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kinds[kind])).cast("long")
    return found.select(
        "doc_id", *(count(kind).alias(f"n_{kind}") for kind in kinds),
        F.sha2(secret_scan.span_text(base), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shared", F.col("item_shingles").cast("long").alias("item_shingles"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.array(*(F.lit(k) for k in pii.KINDS))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda i: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == i))).cast("long")
    return found.select(
        "doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove(table(spark, sf_dir, "documents"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, repaired = conversation_repair.repair(conversation_repair.damage(conversations))
    digests = conversation_repair.digests(repaired)
    all_ids = conversations.select("conv_id").distinct()
    found = all_ids.join(report.withColumnRenamed("conv_id", "_r"), F.col("conv_id").eqNullSafe(F.col("_r")), "left").join(
        digests.withColumnRenamed("conv_id", "_d"), F.col("conv_id").eqNullSafe(F.col("_d")), "left")
    return found.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (
            "gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary).select(
        "doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_quality_rules": op2_quality_rules,
        "op3_license_scan": op3_license_scan,
        "op4_mixing": op4_mixing,
        "op5_secret_scan": op5_secret_scan,
        "op6_simhash_dedup": op6_simhash_dedup,
        "op7_decontaminate": op7_decontaminate,
        "op8_pii": op8_pii,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_lm_scoring": op10_lm_scoring,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_whitening": op13_whitening,
    }


def all_oracles() -> dict[str, str]:
    return {
        "op3_license_scan": license_scan.oracle_sql(),
        "op7_decontaminate": decontaminate.oracle_sql(),
        "op11_conversation_repair": conversation_repair.oracle_sql(),
    }
