"""Latent semantic analysis: decomposition and the similarity queries on its factors.

A factor matrix is a DataFrame of an id and a row ``vec ARRAY<DOUBLE>``; document ids stay with their rows throughout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.functions.matrices import dot_with, unit_rows
from tallyforge.functions.vectors import array_literal, scale
from tallyforge.operators.counting import topk_per_group
from tallyforge.plans.durable import materialize, new_folder

# Default rank, and the length of a result list.
RANK, TOP = 100, 10


@dataclass
class Decomposition:
    """Singular values, document rows ``(doc_id, vec)`` and term rows ``(idx, vec)``."""

    s: list[float]
    u: DataFrame
    v: DataFrame

    @property
    def diagonal(self) -> Column:
        return array_literal(self.s)


def document_entries(weights: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc_id, entries): the terms and weights of each document by term; as many as the vocabulary at most."""
    rows = weights.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("idx", "weight"))).alias("entries"))
    return rows.select(F.col(doc).cast("bigint").alias("doc_id"), "entries")


def document_vectors(entries: DataFrame, size: int) -> DataFrame:
    """(features): one sparse vector per document, by way of the text format of such vectors, which numbers terms from 1."""
    pairs = F.transform("entries", lambda e: F.concat_ws(":", (e["idx"] + 1).cast("string"), e["weight"].cast("string")))
    path = new_folder(entries.sparkSession, "lsa-vectors")
    entries.select(F.concat(F.lit("0 "), F.array_join(pairs, " "))).write.text(path)
    return entries.sparkSession.read.format("libsvm").option("numFeatures", size).load(path).select("features")


def document_rows(entries: DataFrame, v: np.ndarray, s: np.ndarray) -> DataFrame:
    """(doc_id, vec): entries times the term factor, divided by the singular values, in Arrow batches."""
    shared = entries.sparkSession.sparkContext.broadcast(v / s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            flat = lists.flatten()
            idx, weight = flat.field("idx").to_numpy(), flat.field("weight").to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy())
            out = np.empty((batch.num_rows, factor.shape[1]))
            for row, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)):
                out[row] = weight[start:end] @ factor[idx[start:end]]
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * factor.shape[1])
            rows = pa.ListArray.from_arrays(offsets, pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), rows], ["doc_id", "vec"])

    return entries.select("doc_id", "entries").mapInArrow(run, "doc_id bigint, vec array<double>")


def lsa_svd(weights: DataFrame, size: int, k: int = RANK, doc: str = "doc_id") -> Decomposition:
    """Rank-k decomposition of the document-term matrix.

    ``size`` is the vocabulary size. The term factor (size x k numbers) is all that is on the driver and sent to the
    executors, where it gives the document rows; keep ``size`` up to about 50,000 and k up to about 100.
    """
    spark = weights.sparkSession
    entries = materialize(document_entries(weights, doc), "lsa-entries")
    vectors = MLUtils.convertVectorColumnsFromML(document_vectors(entries, size), "features").persist()
    svd = RowMatrix(vectors, numCols=size).computeSVD(k, computeU=False)
    vectors.unpersist()
    v, s = svd.V.toArray(), svd.s.toArray()
    v_rows = [(i, row) for i, row in enumerate(v.tolist())]
    return Decomposition(
        s=s.tolist(), u=document_rows(entries, v, s), v=spark.createDataFrame(v_rows, "idx int, vec array<double>")
    )


def concept_rows(factor: DataFrame, concepts: int, keep: Sequence[str]) -> DataFrame:
    """One row per id and concept, for the first concepts."""
    return factor.select(*keep, F.posexplode(F.slice("vec", 1, concepts)).alias("concept", "weight"))


def lsa_top(factor: DataFrame, key: str, concepts: int = TOP, n: int = TOP) -> DataFrame:
    """The n heaviest ids of each of the first concepts."""
    return topk_per_group(concept_rows(factor, concepts, (key,)), ["concept"], F.col("weight"), [key], n)


def lsa_top_terms(svd: Decomposition, vocab: DataFrame, concepts: int = TOP, n: int = TOP) -> DataFrame:
    return attach_names(lsa_top(svd.v, "idx", concepts, n), vocab.select("idx", "term"), "idx")


def lsa_top_docs(svd: Decomposition, titles: DataFrame, concepts: int = TOP, n: int = TOP) -> DataFrame:
    """``titles`` has columns ``doc_id`` and ``title``."""
    return attach_names(lsa_top(svd.u, "doc_id", concepts, n), titles, "doc_id")


def attach_names(results: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Join names to a result list; the list is short and is what gets broadcast, if anything."""
    return results.join(names, key)


def matrix_row(matrix: DataFrame, key: str, value: object) -> DataFrame:
    return matrix.where(F.col(key) == F.lit(value))


def scale_by_diagonal(matrix: DataFrame, diagonal: Column | Sequence[float], column: str = "vec") -> DataFrame:
    diagonal = diagonal if isinstance(diagonal, Column) else array_literal(diagonal)
    return matrix.withColumn(column, scale(column, diagonal))


def rows_normalize(matrix: DataFrame, column: str = "vec") -> DataFrame:
    """Rows divided by their length; a zero row becomes NULL."""
    return matrix.withColumn(column, unit_rows(F.col(column)))


def score_against(matrix: DataFrame, vector: Sequence[float] | None, key: str, n: int = TOP) -> DataFrame:
    """The n rows with the largest dot product with one vector; rows without a score are left out."""
    if vector is None:
        matrix, vector = matrix.limit(0), [0.0]
    scored = matrix.select(key, dot_with(F.col("vec"), vector).alias("score")).where(F.col("score").isNotNull())
    return scored.orderBy(F.desc("score"), key).limit(n)


def _row_of(matrix: DataFrame, key: str, value: object) -> Sequence[float] | None:
    """One row of a factor, as long as its rank: the only thing a query fetches."""
    row = matrix_row(matrix, key, value).select("vec").first()
    return None if row is None else row.vec


def similar_rows(normal: DataFrame, key: str, value: object, n: int = TOP) -> DataFrame:
    """Cosine of one row with all rows of a matrix whose rows have unit length."""
    return score_against(normal, _row_of(normal, key, value), key, n)


def lsa_terms_for_term(svd: Decomposition, idx: int, n: int = TOP) -> DataFrame:
    return similar_rows(rows_normalize(scale_by_diagonal(svd.v, svd.s)), "idx", idx, n)


def lsa_docs_for_doc(svd: Decomposition, doc_id: int, n: int = TOP) -> DataFrame:
    return similar_rows(rows_normalize(scale_by_diagonal(svd.u, svd.s)), "doc_id", doc_id, n)


def docs_for_row(us: DataFrame, v: DataFrame, key: str, value: object, doc: str = "doc_id", n: int = TOP) -> DataFrame:
    """Dot products of document rows with one row of another matrix."""
    return score_against(us, _row_of(v, key, value), doc, n)


def lsa_docs_for_term(svd: Decomposition, idx: int, n: int = TOP) -> DataFrame:
    return docs_for_row(scale_by_diagonal(svd.u, svd.s), svd.v, "idx", idx, n=n)


def lsa_query_vector(vocab: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Terms of a query as (idx, term, value) with their idf; unknown terms drop out."""
    return vocab.where(F.col("term").isin(*terms)).select("idx", "term", F.col("idf").alias("value"))


def project_query(v: DataFrame, query: DataFrame) -> list[float]:
    """The query times the term factor: one number per concept."""
    parts = v.join(query, "idx").select(F.posexplode("vec").alias("concept", "x"), "value")
    sums = parts.groupBy("concept").agg(F.sum(F.col("x") * F.col("value")).alias("x")).collect()
    by_concept = {r.concept: r.x for r in sums}
    return [by_concept[i] for i in range(len(by_concept))]


def docs_for_query(us: DataFrame, v: DataFrame, query: DataFrame, doc: str = "doc_id", n: int = TOP) -> DataFrame:
    return score_against(us, project_query(v, query) or None, doc, n)


def lsa_docs_for_query(svd: Decomposition, vocab: DataFrame, terms: Sequence[str], n: int = TOP) -> DataFrame:
    return docs_for_query(scale_by_diagonal(svd.u, svd.s), svd.v, lsa_query_vector(vocab, terms), n=n)
