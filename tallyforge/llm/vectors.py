"""Vectors that can be compared, and classes of equal ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def comparable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _vec array<double>) of the rows with an id and a vector that is not zero and has only finite numbers."""
    vec = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("_id"), vec.alias("_vec")).where(F.col("_id").isNotNull() & F.col("_vec").isNotNull())
    inf = float("inf")
    finite = F.forall("_vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf)))
    return rows.where(F.coalesce(finite, F.lit(False)) & F.exists("_vec", lambda x: x != 0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of an Arrow column of number lists of equal length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """The rows scaled to length one; by their largest number first, so that no square is too large or too small."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
