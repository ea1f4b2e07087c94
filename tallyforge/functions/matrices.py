"""Dense arithmetic between a column of vectors and one small matrix that travels with the plan.

Array functions with lambdas are interpreted element by element; for products with a matrix, NumPy on Arrow batches was
about ten times faster. Each function is a Pandas UDF over ARRAY<DOUBLE>; a NULL vector gives NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Numbers of a matrix that is sent with every task. A larger one goes in blocks of rows, with the same result.
MAX_NUMBERS = 4_000_000

# Numbers of one intermediate block.
_BLOCK = 2_000_000


def block_rows(width: int) -> int:
    """How many rows of this width a block has."""
    return max(1, MAX_NUMBERS // max(1, width))


def _by_rows(vectors: pd.Series, work) -> pd.Series:
    """Apply ``work`` to the matrix of non-NULL vectors and put its rows back in place."""
    present = vectors.notna().to_numpy()
    out = np.empty(len(vectors), dtype=object)
    if present.any():
        results = work(np.stack(vectors[present].to_numpy()).astype("float64", copy=False))
        for place, row in zip(np.flatnonzero(present), results):
            out[place] = row
    return pd.Series(out)


def products(vector: Column, rows: Sequence[Sequence[float]]) -> Column:
    """ARRAY<DOUBLE> of the dot products with every row of the matrix, block after block."""
    step = block_rows(len(rows[0]) if len(rows) else 1)
    return F.concat(*[_block_products(vector, rows[start : start + step]) for start in range(0, max(1, len(rows)), step)])


def _block_products(vector: Column, rows: Sequence[Sequence[float]]) -> Column:
    matrix = np.asarray(rows, dtype="float64")

    @F.pandas_udf("array<double>")
    def multiply(vectors: pd.Series) -> pd.Series:
        return _by_rows(vectors, lambda x: list(x @ matrix.T))

    return multiply(vector)


def dot_with(vector: Column, other: Sequence[float]) -> Column:
    """Dot product with one vector."""
    fixed = np.asarray(other, dtype="float64")

    @F.pandas_udf("double")
    def multiply(vectors: pd.Series) -> pd.Series:
        return _by_rows(vectors, lambda x: x @ fixed).astype("float64")

    return multiply(vector)


def unit_rows(vector: Column) -> Column:
    """The vector divided by its length; NULL where the length is 0."""

    def divide(x: np.ndarray) -> list:
        lengths = np.sqrt((x * x).sum(axis=1))
        return [row / n if n > 0 else None for row, n in zip(x, lengths)]

    @F.pandas_udf("array<double>")
    def normalise(vectors: pd.Series) -> pd.Series:
        return _by_rows(vectors, divide)

    return normalise(vector)


def nearest_row(vector: Column, rows: Sequence[Sequence[float]], numbers: Sequence[int]) -> Column:
    """STRUCT of ``cluster`` (the number of the nearest row, the first of equals) and its Euclidean ``distance``."""
    matrix, names = np.asarray(rows, dtype="float64"), np.asarray(numbers, dtype="int32")

    @F.pandas_udf("cluster int, distance double")
    def nearest(vectors: pd.Series) -> pd.DataFrame:
        present = vectors.notna().to_numpy()
        clusters, distances = np.zeros(len(vectors), dtype="int32"), np.full(len(vectors), np.nan)
        if present.any():
            x = np.stack(vectors[present].to_numpy()).astype("float64", copy=False)
            step = max(1, _BLOCK // max(1, matrix.size))
            best, near = [], []
            for start in range(0, len(x), step):
                part = x[start:start + step, None, :] - matrix[None, :, :]
                squares = np.einsum("nkd,nkd->nk", part, part)
                chosen = squares.argmin(axis=1)
                best.append(chosen)
                near.append(np.sqrt(squares[np.arange(len(chosen)), chosen]))
            clusters[present], distances[present] = names[np.concatenate(best)], np.concatenate(near)
        return pd.DataFrame({
            "cluster": pd.Series(clusters).where(present, None).astype("Int32"),
            "distance": pd.Series(distances).where(present, None),
        })

    return nearest(vector)
