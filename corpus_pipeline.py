"""A corpus pipeline over `documents`: quality, near duplicates, benchmark passages, secrets, tokens.

Each stage reads what its predecessor kept and decides on texts: a row is known by a key of its id and its text, so rows without an
id and different texts under one id are judged like all others, each by its own text. Stages return the columns of
documents; other columns, whatever their names, are left behind. Empty tables pass every stage empty. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestream.llm import decontamination, neardup, pieces, quality, secrets
from lodestream.llm.base import staged, table
from lodestream.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
_LAST = 2**63 - 1


def _keyed(docs: DataFrame) -> DataFrame:
    """The columns of documents and ``key``, a 64-bit hash of id and text (nulls apart from empty ones); equal rows have equal keys."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("doc_id").isNull(), "text", F.col("text").isNull())
    return docs.select(*COLUMNS, key.alias("key"))


def _as_ids(keyed: DataFrame) -> DataFrame:
    """What an operator reads: the key in place of the id."""
    return keyed.drop("doc_id").withColumnRenamed("key", "doc_id")


def _of(keyed: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    keys = keys.select(F.col("doc_id").alias("key")).distinct().hint("merge")  # grows with the corpus: never a broadcast
    return keyed.join(keys, "key", how).select(*COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the quality classifier rejects; null and empty texts go, too. A label counts for all texts of its id; repeated rows share a fate."""
    keyed = _keyed(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("id"), "quality")
    labels = keyed.select(F.col("doc_id").cast("long").alias("id"), "key").join(labels.hint("merge"), "id").select(F.col("key").alias("doc_id"), "quality")
    verdict = staged(quality.perplexities(_as_ids(keyed), labels).filter("kept").select("doc_id"), "pipeline-quality")
    return _of(keyed, verdict, "left_semi")


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8) stays: the one of the smallest id (rows without one come last), ties by the key; of equal rows one.

    Null and blank texts are in no group; each stays, once for each id.
    """
    keyed = _keyed(docs)
    found = staged(neardup.near_duplicates(_as_ids(keyed), 5, 80).select(F.col("doc_id").alias("key"), F.col("component_id").alias("group")).distinct(), "pipeline-groups")
    ids = keyed.select("key", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id")).distinct()
    first = found.join(ids.hint("merge"), "key").groupBy("group").agg(F.min(F.struct("id", "key")).alias("m")).select(F.col("m.key").alias("doc_id"))
    # of equal rows one; the limit of one row a key is pushed below the shuffle
    nth = F.row_number().over(Window.partitionBy("key").orderBy("lang", "source", "n_chars"))
    return _of(keyed.withColumn("nth", nth).filter("nth = 1").drop("nth"), staged(first, "pipeline-first"), "left_semi")


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold 0.8 or more of a benchmark item's shingles; null and empty texts hold none; repeated rows share a fate."""
    keyed = _keyed(docs)
    found = decontamination.contained_items(_as_ids(keyed), table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return _of(keyed, staged(found, "pipeline-leaks"), "left_anti")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row stays; found secrets are masked, and n_chars follows. Null texts stay null."""
    return secrets.redact(docs.select(*COLUMNS))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row that is left; a null text counts as empty."""
    return pieces.digests(docs, piece_model())


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one_of_group),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("sentencepiece", tokenise),
]

#: SQL can't express the model, the sketches or the tokenizer; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{name}")
    return docs
