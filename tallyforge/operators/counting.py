"""Counts, frequencies, top-k and other small relational operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.functions.scalars import list_has, split_on_spaces
from tallyforge.plans.layout import unnest


def tokenize_space(lines: DataFrame, column: str = "value") -> DataFrame:
    return unnest(lines, [], split_on_spaces(column), "word")


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    return tokenize_space(lines, column).groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def count_by_value(df: DataFrame, *columns: str, out: str = "cnt") -> DataFrame:
    """Frequency of each value, most frequent first."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(out)).orderBy(F.desc(out), *columns)


def freq_of_freq(counts: DataFrame, column: str = "cnt") -> DataFrame:
    """How many values occur n times, ascending n."""
    return (
        counts.groupBy(F.col(column).alias("occurrences")).agg(F.count(F.lit(1)).alias("values_with"))
        .orderBy("occurrences")
    )


def contains_filter(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.where(F.col(column).contains(part))


def global_count(df: DataFrame, out: str = "cnt") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def distinct_set_size(df: DataFrame, keys: Sequence[str], member: str, approximate: bool = False) -> DataFrame:
    """Size of the set of members per key; exact unless asked otherwise."""
    size = F.approx_count_distinct(member) if approximate else F.count_distinct(F.col(member))
    return df.groupBy(*keys).agg(size.alias("set_size"))


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def topk_by_count(counts: DataFrame, k: int, count: str = "cnt", ties: Sequence[str] = ()) -> DataFrame:
    """The k largest; equal counts are ordered by ``ties``."""
    return counts.orderBy(F.desc(count), *ties).limit(k)


def topk_per_group(df: DataFrame, group: Sequence[str], score: Column, ties: Sequence[str], k: int) -> DataFrame:
    """Best k rows of every group, with their ``rank``.

    The rank filter is pushed below the shuffle, so a hot group sends k rows per input partition, not all of them.
    """
    order = Window.partitionBy(*group).orderBy(score.desc(), *ties)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def kth_largest(df: DataFrame, column: str, k: int = 100) -> DataFrame:
    """One row, column ``threshold``: the k-th largest value, or the smallest where there are fewer."""
    return df.select(column).where(F.col(column).isNotNull()).orderBy(F.desc(column)).limit(k).agg(
        F.min(column).alias("threshold")
    )


def sort_by_metric(df: DataFrame, metric: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(F.desc(metric), *ties)


def sort_tuples(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*(columns or df.columns))


def take_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*(order or df.columns)).limit(n)


def trim_by_frequency(
    freqs: DataFrame, keep: int, count: str = "cnt", ties: Sequence[str] = (), least: bool = True
) -> DataFrame:
    """``keep`` entries, the least frequent ones unless ``least`` is false."""
    return freqs.orderBy(F.asc(count) if least else F.desc(count), *ties).limit(keep)


def lookup_by_key(df: DataFrame, key: str, value: object) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def semi_filter(df: DataFrame, wanted: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key is in ``wanted``."""
    return df.join(wanted, on, "left_semi")


def join_not_member(info: DataFrame, events: DataFrame, on: str, listed: str, item: str) -> DataFrame:
    """Join two tables and keep rows whose item is not in the comma-separated list."""
    return info.join(events, on).where(~list_has(listed, item))


def list_not_contains(df: DataFrame, listed: str, item: str) -> DataFrame:
    return df.where(~list_has(listed, item))
