"""Cubes whose absent dimensions carry a label."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The label of an absent dimension and the columns of the advertising cube.
ABSENT = "_NONE"
AD_FIXED = ["time", "query_type"]
AD_DIMENSIONS = ["os", "source_type", "appid", "source", "active"]


def labelled_cube(
    df: DataFrame,
    fixed: Sequence[str],
    dims: Sequence[str],
    label: str = ABSENT,
    out: str = "cnt",
    grouping_bits: str | None = None,
) -> DataFrame:
    """Row counts for ``fixed`` and every subset of ``dims``; a dimension left out shows ``label``.

    Rows are counted at the finest grain before the fan-out, so its size follows the number of distinct cells and not of
    rows, and a hot cell is one row by then. A NULL or a real value equal to the label stays a cell of its own; column
    ``grouping_bits``, if named, tells the subsets apart.
    """
    fixed, dims = list(fixed), list(dims)
    finest = df.groupBy(*fixed, *dims).agg(F.count(F.lit(1)).alias("_n"))
    subsets = [
        [F.col(c) for c in (*fixed, *chosen)] for size in range(len(dims), -1, -1) for chosen in combinations(dims, size)
    ]
    flags = [F.grouping(d).alias(f"_absent_{d}") for d in dims]
    cells = finest.groupingSets(subsets, *fixed, *dims).agg(F.sum("_n").cast("bigint").alias(out), *flags)
    shown = [F.when(F.col(f"_absent_{d}") == 1, F.lit(label)).otherwise(F.col(d)).alias(d) for d in dims]
    bits = []
    if grouping_bits:
        weights = [F.col(f"_absent_{d}").cast("int") * (1 << (len(dims) - 1 - i)) for i, d in enumerate(dims)]
        bits = [sum(weights[1:], weights[0]).alias(grouping_bits)]
    return cells.select(*fixed, *shown, out, *bits)


def ad_cube(ads: DataFrame) -> DataFrame:
    """Records per ten minutes and query type, over all subsets of the five advertising dimensions."""
    return labelled_cube(ads, AD_FIXED, AD_DIMENSIONS)
