"""The corpus pipeline: filter, deduplicate, decontaminate, scan and mix the documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comanda.llm import decontaminate, mixing, quality_rules, secret_scan, simhash_dedup
from comanda.llm.text import fresh, table
from comanda.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a certified cutoff rejects go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest id."""
    return simhash_dedup.deduplicate(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by a mark; n_chars is that of the new text where it was that of the old."""
    mark = fresh(docs, "counted")
    masked = secret_scan.mask(docs.withColumn(mark, F.col("n_chars").eqNullSafe(F.length("text").cast("long"))))
    return masked.withColumn("n_chars", F.when(F.col(mark), F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*(F.col(f"`{c}`") for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document with its rate, so that domains have their target shares; those with rate 0 go."""
    mixed = mixing.mix(docs, table(spark, sf_dir, "labels"), keep_text=True)
    rate = mixed.columns[-1]  # "rate", unless the documents have such a column
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns), rate).filter(F.col(rate) > 0)


STAGES = [
    ("quality_rules", quality),
    ("simhash_dedup", near_dedup),
    ("decontaminate", benchmark_free),
    ("secret_scan", without_secrets),
    ("mixing", mix),
]

# Fingerprints, certified cutoffs and the classifier have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on all that its predecessor kept, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
