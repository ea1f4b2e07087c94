"""A pipeline from raw documents to token ids: each stage is written as Parquet, which the next one reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import bpe, language_id, mixing, secret_scan, simhash
from tallyforge.llm.queries import vocabulary_path
from tallyforge.plans.durable import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be determined."""
    return language_id.accepted_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (fingerprints of 3-word shingles at most 3 bits apart), that with the smallest id."""
    return simhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked; ``n_chars`` follows the text, and stays where that is NULL."""
    masked = secret_scan.mask_secrets(docs)
    if "n_chars" not in docs.columns:
        return masked
    length = F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", length)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks for."""
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), a row for each copy of a document in the mix."""
    return bpe.round_trip(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("simhash", near_duplicates),
    ("secret_scans", secrets),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: SQL can express neither the fitted language model nor fingerprints, automata and merges; tests check against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
