"""Near-duplicate embeddings: an exact metric range join over a partition by pivots.

Angles between vectors are a metric. Every distinct vector belongs to the cell of its nearest pivot. If x lies in cell i and y
is within the angle r of x, then y is at most 2r farther from pivot i than from its own pivot, and at most r outside the
cell's radius. So y is also sent to every cell where both can hold, and each cell finds all neighbours of its own members
without looking at other cells. Every link is found exactly once from either end.

Cells are joined block by block: members in chunks against visitors in chunks, so that a task is bounded however many vectors
are close to one pivot. A block returns numbers of neighbours, and links enough to connect what is linked, never all pairs.
Equal vectors count as one with a weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.vectors import comparable, matrix, unit_rows
from tallyforge.operators.graph import connected_components
from tallyforge.plans.durable import materialize

LEAST_COSINE = 0.9
#: Vectors per pivot, about, and pivots at most; both bound what is sent to every task.
CELL, MOST_PIVOTS = 4_096, 1_024
#: Members and visitors of a block, at most about.
MEMBERS, VISITORS = 8_192, 16_384
_ROWS = 512
#: Added to every bound on angles for rounding.
_SLACK = 1e-6


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit_rows(vectors) @ pivots.T, -1, 1))


def _assigned(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(rep, weight, vec, cell, angle): the nearest pivot of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                angles = _angles(matrix(batch.column(2), pivots.shape[1]), pivots)
                cell = angles.argmin(axis=1)
                columns = [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(angles[np.arange(len(cell)), cell])]
                yield pa.RecordBatch.from_arrays(columns, ["rep", "weight", "vec", "cell", "angle"])

    kind = classes.schema["rep"].dataType.simpleString()
    schema = f"rep {kind}, weight bigint, vec array<double>, cell int, angle double"
    return classes.select("rep", "weight", "vec").mapInArrow(run, schema)


def _goes(vectors: np.ndarray, pivots: np.ndarray, inner: np.ndarray, outer: np.ndarray, reach: float) -> np.ndarray:
    """Which cells, in columns, each vector visits."""
    angles = _angles(vectors, pivots)
    near = angles.min(axis=1, keepdims=True) + 2 * reach + _SLACK
    return (angles <= near) & (angles <= outer + reach + _SLACK) & (angles >= inner - reach - _SLACK)


def _visit_counts(assigned: DataFrame, pivots: np.ndarray, inner: np.ndarray, outer: np.ndarray, reach: float) -> DataFrame:
    """(cell, n): the number of visitors of each cell; a task adds up its own before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(pivots), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                counts += _goes(matrix(batch.column(0), pivots.shape[1]), pivots, inner, outer, reach).sum(axis=0)
        cell = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(counts[cell])], ["cell", "n"])

    return assigned.select("vec").mapInArrow(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))


def _visits(assigned: DataFrame, pivots: np.ndarray, inner: np.ndarray, outer: np.ndarray, reach: float) -> DataFrame:
    """(rep, weight, vec, cell): every vector in each cell that may hold a neighbour of it, its own included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, cell = _goes(matrix(batch.column(2), pivots.shape[1]), pivots, inner, outer, reach).nonzero()
            # A row may go to many cells: some rows at a time.
            for start in range(0, len(row), 10_000):
                some = slice(start, start + 10_000)
                taken = batch.take(pa.array(row[some]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell[some].astype(np.int32))], ["rep", "weight", "vec", "cell"])

    kind = assigned.schema["rep"].dataType.simpleString()
    return assigned.select("rep", "weight", "vec").mapInArrow(run, f"rep {kind}, weight bigint, vec array<double>, cell int")


def _block_links(members: pa.Table, visitors: pa.Table, size: int, least: float) -> pa.Table:
    """(a, b, weight): per member the weight of its neighbours here (b NULL), and links that connect them (weight 0)."""
    names, others = members.column("rep").to_numpy(), visitors.column("rep").to_numpy()
    weights = visitors.column("weight").to_numpy()
    left, right = (matrix(t.column("vec").combine_chunks(), size) for t in (members, visitors))
    left, right = unit_rows(left), unit_rows(right)
    label = np.arange(len(others))
    a, b, w = [], [], []
    for start in range(0, len(names), _ROWS):
        near = left[start : start + _ROWS] @ right.T >= least
        near &= names[start : start + _ROWS, None] != others[None, :]
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            found = np.flatnonzero(near[row])
            name = names[start + row]
            a.append(name), b.append(None), w.append(int(weights[found].sum()))
            groups = np.unique(label[found])
            for group in groups.tolist():
                a.append(name), b.append(others[group]), w.append(0)
            if len(groups) > 1:
                label[np.isin(label, groups)] = groups[0]
    kind = members.schema.field("rep").type
    return pa.table([pa.array(a, kind), pa.array(b, kind), pa.array(w, pa.int64())], names=["a", "b", "weight"])


def range_join(classes: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(a, b, weight) of distinct vectors (rep, weight, vec) of one length: see ``_block_links``."""
    spark = classes.sparkSession
    count = classes.count()
    first = classes.select("vec").head()
    kind = classes.schema["rep"].dataType.simpleString()
    if first is None:
        return classes.select(F.col("rep").alias("a"), F.col("rep").alias("b"), F.col("weight"))
    size, reach = len(first["vec"]), math.acos(least)
    # Any pivots give all links; these are a bounded choice by hash, the same in every run.
    chosen = classes.orderBy(F.xxhash64("rep"), "rep").limit(min(MOST_PIVOTS, max(1, math.ceil(count / CELL)))).select("vec").collect()
    pivots = unit_rows(np.array([row["vec"] for row in chosen]))
    assigned = materialize(_assigned(classes, pivots), "cells")
    stats = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("inner"), F.max("angle").alias("outer")).collect()
    inner, outer = np.full(len(pivots), math.inf), np.full(len(pivots), -math.inf)
    pieces = [1] * len(pivots)
    for row in stats:
        inner[row["cell"]], outer[row["cell"]] = row["inner"], row["outer"]
        pieces[row["cell"]] = math.ceil(row["n"] / MEMBERS)
    # Blocks of visitors follow the visitors of each cell, so that members are copied as often as their own cell asks for.
    least_parts = max(1, min(2, spark.sparkContext.defaultParallelism // len(pivots)))
    parts = [least_parts] * len(pivots)
    for row in _visit_counts(assigned, pivots, inner, outer, reach).collect():
        parts[row["cell"]] = max(least_parts, math.ceil(row["n"] / VISITORS))

    def of_cell(numbers: list[int]) -> Column:
        return F.element_at(F.array(*map(F.lit, numbers)), F.col("cell") + 1)

    members = assigned.select("rep", "weight", "vec", "cell", F.pmod(F.xxhash64("rep"), of_cell(pieces)).cast("int").alias("piece"))
    members = members.withColumn("part", F.explode(F.sequence(F.lit(0), of_cell(parts) - 1)))
    visitors = _visits(assigned, pivots, inner, outer, reach)
    visitors = visitors.withColumn("part", F.pmod(F.xxhash64("rep"), of_cell(parts)).cast("int"))
    visitors = visitors.withColumn("piece", F.explode(F.sequence(F.lit(0), of_cell(pieces) - 1)))

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            key = left.schema.field("rep").type
            return pa.table([pa.array([], key), pa.array([], key), pa.array([], pa.int64())], names=["a", "b", "weight"])
        return _block_links(left, right, size, least)

    keys = ["cell", "piece", "part"]
    return members.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(join, f"a {kind}, b {kind}, weight bigint")


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = LEAST_COSINE
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``n_links`` counts the other rows of a cosine of ``least`` or more, in double precision; ``component_id`` is the smallest id
    reachable over links; ``kept`` tells whether it is the row's own. Vectors that are NULL, zero, or hold a NULL or a number
    that is not finite link with nothing, and vectors of different lengths not with each other. A row with a NULL id links
    nothing, has no component and is not kept. Repeated rows count each and are repeated. An empty table gives an empty
    result; other columns are not looked at.
    """
    rows = materialize(comparable(vectors, id_col, vector_col), "embeddings")
    classes = rows.groupBy(F.col("_vec").alias("vec")).agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("weight"))
    classes = materialize(classes, "embedding-classes")
    # Two vectors of one id are classes of their own, told apart by a number.
    classes = classes.withColumn("_of", F.col("rep")).withColumn("rep", F.monotonically_increasing_id())
    classes = materialize(classes, "embedding-numbers")
    sizes = [row["size"] for row in classes.select(F.size("vec").alias("size")).distinct().orderBy("size").collect()]
    found = None
    for size in sizes:  # one, in a table of embeddings
        links = range_join(classes.where(F.size("vec") == size).select("rep", "weight", "vec"), least)
        found = links if found is None else found.unionByName(links)
    if found is None:
        found = classes.select(F.col("rep").alias("a"), F.col("rep").alias("b"), "weight")
    found = materialize(found, "embedding-links")
    counts = found.groupBy(F.col("a").alias("rep")).agg(F.sum("weight").alias("near"))
    edges = found.where(F.col("b").isNotNull()).select(F.col("a").alias("src"), F.col("b").alias("dst"))
    parts = connected_components(classes.select(F.col("rep").alias("id")), edges).withColumnRenamed("id", "rep")
    joined = classes.join(parts, "rep").join(counts, "rep", "left")
    joined = materialize(joined.select("vec", "_of", "component", "weight", F.coalesce("near", F.lit(0)).alias("near")), "embedding-parts")
    least_ids = materialize(joined.groupBy("component").agg(F.min("_of").alias("component_id")), "embedding-least")
    named = joined.join(least_ids, "component").select("vec", "component_id", (F.col("near") + F.col("weight") - 1).alias("n_links"))
    named = materialize(named, "embedding-named")

    linked = rows.join(named, F.col("_vec") == F.col("vec")).select("_id", "n_links", "component_id")
    # The rows that take no part: all rows less those that do, told by the same conditions.
    alone = _left_out(vectors, id_col, vector_col)
    out = linked.unionByName(alone)
    return out.select(
        F.col("_id").alias(id_col), F.col("n_links").cast("bigint").alias("n_links"), "component_id",
        F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _left_out(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    vec = F.col("_vec")
    inf = float("inf")
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).cast("array<double>").alias("_vec"))
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(inf)))
    good = F.col("_id").isNotNull() & vec.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(vec, lambda x: x != 0), F.lit(False))
    return rows.where(~good).select("_id", F.lit(0).cast("bigint").alias("n_links"), F.col("_id").alias("component_id"))
