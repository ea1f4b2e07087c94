"""Logistic regression by gradient steps of falling size, each over all rows or a random part of them.

A step is one job: tasks add up the gradient of their rows, partial sums are added by feature as whole multiples of
2^-32, and the driver gets one sum per feature. Whole numbers add up to the same sum in any order, so that a fit on stored
rows repeats exactly. The model travels with the tasks; its size is the number of features. Rows are stored as blocks of
packed components, since every step reads them all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyforge.plans.durable import materialize

_UNIT = 2.0 ** 32

# Rows are drawn in parts of this.
_DRAWS = 1_000_000_000

# Components of a block of rows (a longer row is a block), and blocks that a task holds at once.
_BLOCK, _HELD = 250_000, 16
_BLOCKS = "at binary, parts binary, counts binary, labels binary, numbers array<bigint>"


@dataclass(frozen=True)
class LinearModel:
    """Weights without an intercept, the steps that were taken, and whether the last one was within the tolerance."""

    weights: np.ndarray
    steps: int
    settled: bool


def logistic_sgd(
    rows: DataFrame, size: int, iterations: int = 100, step: float = 1.0, reg: float = 0.01, fraction: float = 1.0,
    tolerance: float = 0.001, seed: int = 0,
) -> LinearModel:
    """Fit ``label`` (0 or 1) on the vectors ``features`` of ``size`` components.

    Step t goes ``step / sqrt(t)`` along the mean gradient of the rows drawn, with an L2 penalty of ``reg``. A step that
    draws no row changes nothing. Ends early once a step is shorter than ``tolerance`` times the longer of the model and 1.
    Rows with a NULL label or vector are left out; without rows all weights are 0.
    """
    spark = rows.sparkSession
    kept = rows.where(F.col("label").isNotNull() & F.col("features").isNotNull())
    kept = kept.select("features", F.col("label").cast("double").alias("label"), F.monotonically_increasing_id().alias("number"))
    cells = _BLOCK
    kept = materialize(kept.mapInArrow(lambda batches: _blocks(batches, cells), _BLOCKS), "sgd-rows")
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(most)
    spark.conf.set(most, str(_HELD))
    try:
        return _steps(kept, size, iterations, step, reg, fraction, tolerance, seed)
    finally:
        spark.conf.set(most, before)


def _steps(
    kept: DataFrame, size: int, iterations: int, step: float, reg: float, fraction: float, tolerance: float, seed: int
) -> LinearModel:
    weights = np.zeros(size)
    for t in range(1, iterations + 1):
        drawn = F.lit(None).cast("array<boolean>")
        if fraction < 1.0:
            drawn = F.transform(
                "numbers", lambda n: F.pmod(F.xxhash64(n, F.lit(seed), F.lit(t)), F.lit(_DRAWS)) < int(fraction * _DRAWS)
            )
        gradient, n = _gradient(kept, drawn, weights)
        if n == 0:
            continue
        rate = step / np.sqrt(t)
        after = weights * (1.0 - rate * reg) - rate * gradient / n
        moved = np.linalg.norm(after - weights)
        weights = after
        if moved < tolerance * max(np.linalg.norm(after), 1.0):
            return LinearModel(weights, t, True)
    return LinearModel(weights, iterations, False)


def predict(model: LinearModel, df: DataFrame) -> DataFrame:
    """Add ``prediction``: 1.0 above the boundary, else 0.0, NULL for a NULL vector; ``features`` is dropped."""
    weights = model.weights
    kept = [c for c in df.columns if c not in ("features", "prediction")]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField("prediction", T.DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values, row = _cells(batch.column("features"))
            margins = np.bincount(row, values * weights[at], minlength=batch.num_rows)
            absent = np.asarray(batch.column("features").is_null())
            prediction = pa.array((margins > 0).astype("float64"), mask=absent)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + [prediction], names=[*kept, "prediction"])

    return df.select(*kept, "features").mapInArrow(score, schema)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows packed together: features, values, components per row and labels as the bytes of arrays, and the rows' numbers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at, values, row = _cells(batch.column("features"))
        order = np.argsort(row, kind="stable")
        at, values = at[order].astype("<i4"), values[order].astype("<f8")
        counts = np.bincount(row, minlength=batch.num_rows).astype("<i8")
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype("<f8")
        ends = np.cumsum(counts)
        start = 0
        while start < batch.num_rows:
            first = ends[start] - counts[start]
            stop = max(start + 1, int(np.searchsorted(ends, first + most, side="right")))
            cells = slice(first, ends[stop - 1])
            packed = [part.tobytes() for part in (at[cells], values[cells], counts[start:stop], labels[start:stop])]
            numbers = pa.array([batch.column("number").slice(start, stop - start).to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.binary()) for part in packed] + [numbers], names=["at", "parts", "counts", "labels", "numbers"]
            )
            start = stop


def _gradient(blocks: DataFrame, drawn: Column, weights: np.ndarray) -> tuple[np.ndarray, int]:
    size = len(weights)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(size), 0
        for batch in batches:
            for *packed, chosen in zip(*batch.columns, strict=True):
                at, values, counts, labels = (
                    np.frombuffer(part.as_py(), kind) for part, kind in zip(packed, ("<i4", "<f8", "<i8", "<f8"), strict=True)
                )
                if chosen.is_valid:
                    rows = chosen.values.to_numpy(zero_copy_only=False).astype(bool)
                    cells = np.repeat(rows, counts)
                    at, values, counts, labels = at[cells], values[cells], counts[rows], labels[rows]
                row = np.repeat(np.arange(len(counts)), counts)
                margins = np.bincount(row, values * weights[at], minlength=len(counts))
                errors = 1.0 / (1.0 + np.exp(-np.clip(margins, -700, 700))) - labels
                total += np.bincount(at, values * errors[row], minlength=size)
                n += len(counts)
        some = np.flatnonzero(total)
        places = np.append(some, -1).astype("int32")
        sums = np.append(np.rint(total[some] * _UNIT), n).astype("int64")
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(sums)], names=["place", "part"])

    parts = blocks.select("at", "parts", "counts", "labels", drawn.alias("drawn")).mapInArrow(partial, "place int, part long")
    sums = parts.groupBy("place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
    found = {r.place: int(r.total) for r in sums}
    n = found.pop(-1, 0)
    gradient = np.zeros(size)
    for place, whole in found.items():
        gradient[place] = whole / _UNIT
    return gradient, n


def _cells(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, value and row of every stored component; a vector is sparse (with indices) or dense."""
    ats, values, rows = [np.empty(0, "int64")], [np.empty(0)], [np.empty(0, "int64")]
    kinds = vectors.field("type").to_numpy(zero_copy_only=False)
    for kind in (0, 1):
        chosen = np.flatnonzero((kinds == kind) & ~np.asarray(vectors.is_null()))
        if not len(chosen):
            continue
        part = vectors.take(pa.array(chosen))
        numbers = part.field("values")
        counts = numbers.value_lengths().to_numpy(zero_copy_only=False)
        if kind == 0:
            ats.append(part.field("indices").flatten().to_numpy(zero_copy_only=False))
        else:
            ats.append(np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        values.append(numbers.flatten().to_numpy(zero_copy_only=False))
        rows.append(np.repeat(chosen, counts))
    return np.concatenate(ats).astype("int64"), np.concatenate(values), np.concatenate(rows).astype("int64")
