"""Registration of queries and access to the test tables."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL another engine checks it with."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """Run SQL over the test tables it names."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", text):
            table(spark, folder, name).createOrReplaceTempView(name)
    return spark.sql(text)


def rounded(column: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)
