"""Partitioning of inputs, and columns that must not be computed again and again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(scan: DataFrame, *keys: str, at_least: int | None = None) -> DataFrame:
    """Spread a scan over the cores if it has fewer partitions than that; otherwise leave it alone.

    For work per row that is heavy next to the row's size, such as parsing or splitting text, on a table that comes as a
    few small files. A large table has splits enough and is not shuffled. ``keys`` should be near unique.
    """
    context = scan.sparkSession.sparkContext
    wanted = at_least or context.defaultParallelism
    if scan.rdd.getNumPartitions() >= wanted:
        return scan
    return scan.repartition(wanted, *keys)


def computed_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a column that is computed once per row, whatever is done with it later.

    Written as a one-element explode: filters and projections on a plain column are merged into the expression, so a
    parse that three conditions look at runs four times, and below the next shuffle; through a generator they cannot be.
    """
    return df.select("*", F.explode_outer(F.array(expression)).alias(name))


def unnest(df: DataFrame, keep: Sequence[str], array: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per non-NULL element of an array that is expensive to build.

    A plain explode adds a filter for empty arrays beneath it, which builds every array twice; the outer form does not,
    and its rows for empty arrays are dropped afterwards.
    """
    if position is None:
        rows = df.select(*keep, F.explode_outer(array).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(array).alias(position, name))
    return rows.where(F.col(name).isNotNull())
