"""The four reports over parsed access logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sizes of the reports.
STATUS_ROWS = 1000
IP_ROWS = 100
IP_MORE_THAN = 10
ENDPOINT_ROWS = 10


def content_stats(logs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Whole-number mean, smallest and largest content size."""
    return logs.groupBy(*by).agg(
        F.expr("sum(content_size) div count(1)").alias("avg_size"),
        F.min("content_size").alias("min_size"),
        F.max("content_size").alias("max_size"),
    )


def status_counts(logs: DataFrame, rows: int | None = STATUS_ROWS) -> DataFrame:
    counts = logs.groupBy("response_code").agg(F.count(F.lit(1)).alias("total"))
    return counts if rows is None else counts.orderBy("response_code").limit(rows)


def frequent_ips(logs: DataFrame, more_than: int = IP_MORE_THAN, rows: int | None = IP_ROWS) -> DataFrame:
    counts = logs.groupBy("ip_address").agg(F.count(F.lit(1)).alias("total")).where(F.col("total") > more_than)
    return counts if rows is None else counts.orderBy(F.desc("total"), "ip_address").limit(rows)


def top_endpoints(logs: DataFrame, rows: int = ENDPOINT_ROWS) -> DataFrame:
    counts = logs.groupBy("endpoint").agg(F.count(F.lit(1)).alias("total"))
    return counts.orderBy(F.desc("total"), "endpoint").limit(rows)


def bytes_and_requests(logs: DataFrame, by: tuple[str, ...] = ("ip_address",)) -> DataFrame:
    """Sum of bytes and number of requests per address, in one pass instead of a join of two."""
    return logs.groupBy(*by).agg(
        F.sum("content_size").cast("bigint").alias("bytes"), F.count(F.lit(1)).alias("requests")
    )
