"""Corpus pipeline: toxicity, exact and near deduplication, benchmark decontamination, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hillwarden.llm import decontaminate, exact_dedup, near_dup, packing, toxicity
from hillwarden.llm.queries import tokenizer_path
from hillwarden.llm.tables import keep, kept_so_far, release, without


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject.

    The score is a function of the text, and so of the row key: rows are dropped by it.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rejected = keep(toxicity.toxicity(docs, labels).where("predicted = 1").select("rk").distinct())
    return without(docs, rejected)


def exact_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts."""
    return exact_dedup.first_copies(docs, keep(exact_dedup.exact_dedup(docs)))


def near_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that with the least doc_id."""
    classes = near_dup.near_duplicates(docs)
    # equal rows share a key: a key stays if any of its rows does
    return without(docs, keep(classes.groupBy("rk").agg(F.bool_or("kept").alias("kept")).where(~F.col("kept")).select("rk")))


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, keep(decontaminate.contamination(docs, benchmark).where("contaminated").select("rk").distinct()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of what was kept in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_filter),
    ("exact_dedup", exact_filter),
    ("near_dedup", near_filter),
    ("decontamination", benchmark_filter),
    ("packing", packed),
]

#: Signatures, trees and the packing program have no SQL form; a brute-force version is in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stage's rows stored and read again; what a stage built to get there is removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = kept_so_far()
    for _, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir))
        release(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)
