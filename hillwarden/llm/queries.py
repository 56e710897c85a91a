"""Registered queries of the training-data operators, with their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hillwarden.llm import class_lm, decontaminate, exact_dedup, langid, licenses, near_dup, packing, periodic, pii, quality, token_files, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and kept flag of every document, by its whole normalised text."""
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents")).drop("rk")


OP1_SQL = r"""
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha AS text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS sha FROM documents)
WINDOW w AS (PARTITION BY sha)"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class model's and add-one unigram's log10 probability of every document."""
    return class_lm.class_scores(_table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document."""
    return pii.detect(_table(spark, sf_dir, "documents")).drop("rk")


def op7_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents")).drop("rk")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("rk")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written as fixed-width blocks and read back."""
    return token_files.read_tokens(token_files.write_tokens(_table(spark, sf_dir, "documents"), tokenizer_path()))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand inside a benchmark window."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("rk")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences whose digest equals that of a document's whole text or of one of its blocks."""
    return licenses.scan(_table(spark, sf_dir, "documents"), licenses.registry(spark))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First four whitened components of every usable embedding."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words, every tenth document's tail made periodic."""
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"), plant=True).drop("collapsed")


QUERIES = {
    "op5_pii": op5_pii,
    "op2_class_lm": op2_class_lm,
    "op7_near_dup": op7_near_dup,
    "op3_language": op3_language,
    "op10_toxicity": op10_toxicity,
    "op4_packing": op4_packing,
    "op9_token_files": op9_token_files,
    "op1_exact_dedup": op1_exact_dedup,
    "op6_decontaminate": op6_decontaminate,
    "op8_license_scan": op8_license_scan,
    "op11_quality": op11_quality,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_license_scan": licenses.sql(),
}
