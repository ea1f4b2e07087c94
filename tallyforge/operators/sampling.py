"""Samples and splits. The hash forms depend on the key alone, so they repeat on any engine and any partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.scalars import portable_bucket

_GRAIN = 10_000


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Bernoulli sample without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_hash(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    return df.where(portable_bucket(key, _GRAIN, seed) < round(fraction * _GRAIN))


def random_split(df: DataFrame, weights: Sequence[float], seed: int | None = None) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def label_split(df: DataFrame, key: str, weights: Sequence[float], seed: int = 0, out: str = "part") -> DataFrame:
    """Add the number of the split each row belongs to, decided by its key."""
    bucket, edge, part = portable_bucket(key, _GRAIN, seed), 0.0, F.lit(len(weights) - 1)
    edges = []
    for weight in weights:
        edge += weight / sum(weights)
        edges.append(round(edge * _GRAIN))
    for i in range(len(weights) - 2, -1, -1):
        part = F.when(bucket < edges[i], F.lit(i)).otherwise(part)
    return df.withColumn(out, part)


def split_by_hash(df: DataFrame, key: str, weights: Sequence[float], seed: int = 0) -> list[DataFrame]:
    labelled = label_split(df, key, weights, seed, "_part")
    return [labelled.where(F.col("_part") == i).drop("_part") for i in range(len(weights))]
