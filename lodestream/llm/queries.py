"""Registry of the training-data queries and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import collocations, decontamination, fingerprints, licenses, neardup, pieces, quality, rewrite, secrets, sharding, tokenfiles, toxicity, urls
from .base import table
from .oracle import ORACLE  # noqa: F401


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_size(table(spark, sf_dir, "documents"), 40)


def piece_model() -> str:
    """Where this machine keeps the public 32k piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_documents(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 2, 80)


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def byte_tokenizer() -> str:
    """Where this machine keeps the public 50k byte-level tokenizer."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfiles.write(table(spark, sf_dir, "documents"), byte_tokenizer(), end_id=2)
    return tokenfiles.read(files).select("doc_id", "start", "n_tokens", tokenfiles.crc32_of("ids").alias("ids_crc32"))


def op13_schema_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewrite.drifted_clients(table(spark, sf_dir, "clients"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op5_quality": op5_quality,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_licences": op7_licences,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fingerprints": op9_fingerprints,
    "op10_url_filter": op10_url_filter,
    "op4_sharding": op4_sharding,
    "op11_collocations": op11_collocations,
    "op12_token_files": op12_token_files,
    "op13_schema_rewrite": op13_schema_rewrite,
}
